"""Reading raw delimited text and writing tables, reports and logs."""
