SELECT
  CAST(to_date(wall_dt) AS TIMESTAMP_NTZ) + make_dt_interval(0, hour(wall_dt)) AS order_hour,
  count(*) AS cnt
FROM (
  SELECT
    CASE WHEN typeof(order_dt) = 'timestamp'
      THEN convert_timezone('UTC', :zone, TIMESTAMP_NTZ '1970-01-01' + INTERVAL '0.000001' SECOND * unix_micros(CAST(order_dt AS TIMESTAMP)))
      ELSE CAST(order_dt AS TIMESTAMP_NTZ)
    END AS wall_dt
  FROM IDENTIFIER(:src_schema || '.orders')
  WHERE order_dt >= :start AND order_dt < :end
)
GROUP BY ALL
ORDER BY order_hour
