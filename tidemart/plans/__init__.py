"""The layers: raw lines to clean tables to star schema to reports."""
