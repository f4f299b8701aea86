"""flowline: dataflow ingestion, lineage and status analytics on PySpark DataFrames."""
