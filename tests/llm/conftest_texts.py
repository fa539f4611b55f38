"""Texts that tokenizers often get wrong."""

ODD_TEXTS = [
    "", " ", "\n", "   ", "\n\n a  b\n", "a\tb \x1c c\x85d\xa0e", "don't I'll  we're x'",
    "x" * 300, "日本語 テキスト😀 12345", " lead", "trail ", "\r\nab\r\n c", "a \x00 b\x00",
    "<|endoftext|> a<|endoftext|>", "one\ntwo three\nfour", "a\n b", "a \nb", "\na", "a\n",
    "x\ty\n b", "a b c", "ﬁ ½ ²³ Ⅷ", "é combining", "tab\tone  \n two",
]
