CREATE TABLE IF NOT EXISTS IDENTIFIER(:table) (
  id BIGINT NOT NULL,
  name VARCHAR(255),
  age INT,
  created_at TIMESTAMP NOT NULL DEFAULT current_timestamp(),
  updated_at TIMESTAMP NOT NULL DEFAULT current_timestamp()
)
USING PARQUET
