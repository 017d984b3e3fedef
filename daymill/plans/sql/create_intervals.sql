CREATE TABLE IF NOT EXISTS IDENTIFIER(:table) (
  interval_start TIMESTAMP_NTZ NOT NULL,
  interval_end TIMESTAMP_NTZ NOT NULL
)
USING PARQUET
