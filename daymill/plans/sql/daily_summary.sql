SELECT
  to_date(wall_dt) AS summary_date,
  count(*) AS order_cnt,
  CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) AS total_amount
FROM (
  SELECT
    amount,
    CASE WHEN typeof(order_dt) = 'timestamp'
      THEN convert_timezone('UTC', :zone, TIMESTAMP_NTZ '1970-01-01' + INTERVAL '0.000001' SECOND * unix_micros(CAST(order_dt AS TIMESTAMP)))
      ELSE CAST(order_dt AS TIMESTAMP_NTZ)
    END AS wall_dt
  FROM IDENTIFIER(:src_schema || '.orders')
  WHERE order_dt >= :start AND order_dt < :end
)
GROUP BY ALL
