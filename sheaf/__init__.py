"""Small DataFrame-in, DataFrame-out operators for everyday data work on text, tables and graphs."""
