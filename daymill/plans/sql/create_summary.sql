CREATE TABLE IF NOT EXISTS IDENTIFIER(:table) (
  summary_date DATE NOT NULL,
  order_cnt BIGINT NOT NULL,
  total_amount DECIMAL(18, 2) NOT NULL,
  created_at TIMESTAMP DEFAULT current_timestamp(),
  updated_at TIMESTAMP DEFAULT current_timestamp(),
  summary_month STRING
)
USING PARQUET
OPTIONS ('partitionOverwriteMode' = 'dynamic')
PARTITIONED BY (summary_month)
