"""Reading and writing: raw events, the date-partitioned lake, named tables, the insight store."""
