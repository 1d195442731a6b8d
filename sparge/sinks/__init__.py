"""Writers: Parquet files, partitioned tables, marts, compaction."""
