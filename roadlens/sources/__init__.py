"""Reading and writing: delimited text, typed tables, reports."""
