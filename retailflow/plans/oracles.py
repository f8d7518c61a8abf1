"""SQL that states the result of the registered queries over the same tables."""

from __future__ import annotations

from retailflow.plans.catalogue import CAMPAIGNS, HALF, HISTORY_TTL, LAST_SEEN_ITEM, LAST_SEEN_MS, NOW_MS, WINDOW_SECONDS

WINDOW_LABEL = f"{WINDOW_SECONDS}s"


def _round2(x: str) -> str:
    return f"(floor(({x}) * 100 + 0.5) / 100.0)"


def _charm(price: str, ending: str = "0.99::DOUBLE") -> str:
    whole = f"floor({price})"
    candidate = (
        f"CASE WHEN {whole} + {ending} > ({price}) THEN ({whole} - 1.0::DOUBLE) + {ending} "
        f"ELSE {whole} + {ending} END"
    )
    return _round2(f"greatest({candidate}, 0.0::DOUBLE)")


CLICKS = """clicks AS (
  SELECT event_id, epoch_us(ts) // 1000 AS event_time, user_id AS visitor_id,
         CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction'
              ELSE event_type END AS event,
         TRY_CAST(props->>'$.k' AS BIGINT) AS item_id,
         CASE WHEN event_type <> 'view' THEN value END AS price
  FROM events)"""

SILVER = """silver AS (
  SELECT DISTINCT make_timestamp(event_time * 1000) AS event_time, visitor_id, event, item_id, price
  FROM clicks
  WHERE event IN ('view', 'addtocart', 'transaction') AND item_id > 0)"""

WINDOWS = f"""windows AS (
  SELECT item_id, window_start, window_start + to_seconds({WINDOW_SECONDS}) AS window_end,
         count(*) FILTER (event = 'transaction') AS velocity,
         count(*) FILTER (event = 'view') AS view_count,
         count(*) FILTER (event = 'addtocart') AS addtocart_count,
         arg_max(price, (event_time, price)) FILTER (price IS NOT NULL) AS last_price
  FROM (SELECT *, make_timestamp((epoch_us(event_time) // ({WINDOW_SECONDS} * 1000000::BIGINT))
                                 * ({WINDOW_SECONDS} * 1000000::BIGINT)) AS window_start FROM silver)
  GROUP BY item_id, window_start)"""


def _features(name: str, source: str) -> str:
    return f"""{name}_daily AS (
  SELECT item_id, CAST(event_time AS DATE) AS ds, count(*) AS daily_txn
  FROM {source} WHERE event = 'transaction' GROUP BY ALL),
{name} AS (
  SELECT item_id, ds,
         avg(daily_txn) OVER (PARTITION BY item_id ORDER BY ds ROWS 6 PRECEDING) AS velocity_7d,
         avg(daily_txn) OVER (PARTITION BY item_id ORDER BY ds ROWS 29 PRECEDING) AS velocity_30d,
         CAST(dayofweek(ds) + 1 AS INTEGER) AS dow,
         dayofweek(ds) IN (0, 6) AS is_weekend,
         CAST(lead(daily_txn) OVER (PARTITION BY item_id ORDER BY ds) AS DOUBLE) AS label
  FROM {name}_daily)"""


FORECAST = _features("click_features", "silver") + """,
forecast AS (
  SELECT item_id, velocity_30d AS forecast_demand FROM click_features WHERE label IS NULL)"""

SALES = """sales AS (
  SELECT l_shipdate AS event_time, l_partkey + 1 AS item_id, 'transaction' AS event FROM lineitem)"""

PROPERTIES = f"""properties AS (
  SELECT CAST(epoch_us(l_shipdate) // 1000 AS VARCHAR) AS timestamp, CAST(l_partkey + 1 AS VARCHAR) AS itemid,
         '790' AS property, 'n' || CAST({_round2('l_extendedprice / l_quantity')} AS VARCHAR) AS value
  FROM lineitem
  UNION ALL
  SELECT CAST(epoch_us(l_shipdate) // 1000 AS VARCHAR), CAST(l_partkey + 1 AS VARCHAR),
         'available', CASE WHEN l_returnflag = 'R' THEN '0' ELSE '1' END
  FROM lineitem)"""

INVENTORY = """inventory AS (
  SELECT item_id, stock FROM (
    SELECT CAST(itemid AS BIGINT) AS item_id,
           CASE WHEN TRY_CAST(value AS INTEGER) = 1 THEN 200 ELSE 0 END AS stock,
           row_number() OVER (PARTITION BY itemid ORDER BY CAST(timestamp AS BIGINT) DESC,
             CASE WHEN TRY_CAST(value AS INTEGER) = 1 THEN 200 ELSE 0 END DESC) AS rn
    FROM properties WHERE property = 'available') WHERE rn = 1)"""

CATALOG_PRICE = """catalog_price AS (
  SELECT item_id, catalog_price FROM (
    SELECT CAST(itemid AS BIGINT) AS item_id,
           TRY_CAST(regexp_replace(value, '^n', '') AS DOUBLE) AS catalog_price,
           row_number() OVER (PARTITION BY itemid ORDER BY CAST(timestamp AS BIGINT) DESC,
             TRY_CAST(regexp_replace(value, '^n', '') AS DOUBLE) DESC NULLS LAST) AS rn
    FROM properties WHERE property = '790') WHERE rn = 1 AND catalog_price IS NOT NULL)"""


def _edges(name: str, baskets: str) -> str:
    """Edges by the plain self join, without the pre-aggregation of the Spark side."""
    return f"""{name}_pairs AS (
  SELECT l.item_id AS src, r.item_id AS dst, count(*) AS co_count
  FROM ({baskets}) l JOIN ({baskets}) r ON l.visitor_id = r.visitor_id AND l.item_id < r.item_id
  GROUP BY ALL),
{name} AS (
  SELECT src AS item_id, dst AS related_item_id,
         co_count / CAST((SELECT coalesce(max(co_count), 1) FROM {name}_pairs) AS DOUBLE) AS elasticity_weight
  FROM {name}_pairs)"""


CLICK_EDGES = _edges("click_edges", "SELECT visitor_id, item_id FROM silver WHERE event = 'transaction'")
ORDER_EDGES = _edges("order_edges", "SELECT l_orderkey AS visitor_id, l_partkey + 1 AS item_id FROM lineitem")
CUSTOMER_EDGES = _edges(
    "customer_edges",
    "SELECT o_custkey AS visitor_id, l_partkey + 1 AS item_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
)

SERVING_ROWS = """universe AS (
  SELECT item_id FROM forecast UNION SELECT item_id FROM click_edges
  UNION SELECT item_id FROM inventory UNION SELECT item_id FROM catalog_price),
serving AS (
  SELECT u.item_id, f.forecast_demand, e.max_elasticity,
         CASE WHEN e.max_elasticity IS NOT NULL THEN g.label END AS community,
         CAST(i.stock AS INTEGER) AS stock, c.catalog_price AS price,
         CAST(NULL AS DOUBLE) AS velocity, CAST(NULL AS VARCHAR) AS velocity_window
  FROM universe u
  LEFT JOIN forecast f USING (item_id)
  LEFT JOIN (SELECT item_id, max(elasticity_weight) AS max_elasticity FROM click_edges GROUP BY 1) e USING (item_id)
  LEFT JOIN communities g ON g.id = u.item_id
  LEFT JOIN inventory i USING (item_id)
  LEFT JOIN catalog_price c USING (item_id))"""


def _surge(prob: str) -> str:
    return f"""surging AS (
  SELECT *,
    CASE WHEN surge_prob >= 0.5 AND window_baseline > 0 AND velocity / window_baseline > 2.0
         THEN TRUE ELSE FALSE END AS is_surge
  FROM (SELECT w.item_id, w.window_start, w.window_end, w.velocity, w.last_price,
          s.price AS stored_price, s.stock, coalesce(s.max_elasticity, 0.0) AS elasticity,
          coalesce(s.forecast_demand, 0.0) AS baseline,
          CASE WHEN coalesce(s.forecast_demand, 0.0) > 0
               THEN greatest(s.forecast_demand * ({WINDOW_SECONDS} / 86400.0::DOUBLE), 0.01::DOUBLE)
               ELSE 0.0::DOUBLE END AS window_baseline,
          CAST({prob} AS DOUBLE) AS surge_prob
        FROM windows w LEFT JOIN serving s USING (item_id))),
lifted AS (
  SELECT *,
    CASE WHEN is_surge
         THEN least(0.35::DOUBLE * (velocity / window_baseline - 2.0::DOUBLE)
                    * (1.0::DOUBLE - least(greatest(elasticity, 0.0::DOUBLE), 1.0::DOUBLE)), 0.25::DOUBLE)
         ELSE 0.0::DOUBLE END AS uplift
  FROM surging)"""


_NEW = _round2("base_price * (1.0::DOUBLE + uplift)")
_SHOWN = _charm(f"greatest({_NEW}, base_price)")

WALK = f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY window_start) AS n FROM lifted),
based AS (
  SELECT *, coalesce(last_price, stored_price, 0.0) AS base_price FROM numbered WHERE n = 1),
walk AS (
  SELECT item_id, n, base_price, {_SHOWN} AS new_price FROM based
  UNION ALL
  SELECT item_id, n, base_price, {_SHOWN} AS new_price
  FROM (SELECT c.item_id, c.n, coalesce(c.last_price, p.new_price) AS base_price, c.uplift
        FROM walk p JOIN numbered c ON c.item_id = p.item_id AND c.n = p.n + 1)),
decided AS (
  SELECT d.item_id, d.window_start, d.window_end, w.base_price, w.new_price,
         CAST(d.velocity AS DOUBLE) AS velocity, d.baseline, d.surge_prob, d.is_surge, d.stock, d.uplift
  FROM walk w JOIN numbered d USING (item_id, n)),
updates AS (
  SELECT epoch_us(window_end) // 1000 AS event_time, item_id, base_price, new_price, velocity, baseline, surge_prob,
         printf('surge_prob=%.2f note=%s anchor=%s', surge_prob,
           CASE WHEN moved AND guarded > base_price THEN 'surge-premium'
                WHEN moved THEN 'adjusted' ELSE 'baseline' END,
           CASE WHEN moved THEN CAST({_round2('base_price')} AS VARCHAR) ELSE 'None' END) AS reason
  FROM (SELECT *, abs(guarded - base_price) >= 0.01 AS moved
        FROM (SELECT *, greatest({_NEW}, base_price) AS guarded FROM decided)))"""

_SHARE = "w.velocity / CAST(w.velocity + w.view_count + w.addtocart_count AS DOUBLE)"

ALERTS = """alerts AS (
  SELECT epoch_us(w.window_end) // 1000 AS event_time, w.item_id, 'LOW_STOCK' AS alert_type,
         s.stock AS stock_level, 50 AS reorder_threshold,
         'SKU ' || w.item_id || ' stock ' || s.stock || ' below threshold 50' AS message
  FROM windows w JOIN serving s USING (item_id) WHERE s.stock < 50)"""

LIVE = f"""live AS (
  SELECT item_id, arg_max(new_price, window_start) AS price, arg_max(velocity, window_start) AS velocity,
         '{WINDOW_LABEL}' AS velocity_window
  FROM decided GROUP BY item_id),
live_table AS (
  SELECT coalesce(l.item_id, s.item_id) AS item_id, s.forecast_demand, s.max_elasticity, s.community, s.stock,
         coalesce(l.price, s.price) AS price, l.velocity, l.velocity_window
  FROM serving s FULL JOIN live l ON l.item_id = s.item_id)"""

def _communities(rounds: int = 5) -> list[str]:
    parts = [
        """neighbours AS (
  SELECT item_id AS src, related_item_id AS dst FROM order_edges
  UNION ALL SELECT related_item_id, item_id FROM order_edges)""",
        """labels_0 AS (SELECT DISTINCT src AS id, src AS label FROM neighbours)""",
    ]
    for i in range(rounds):
        parts.append(
            f"""labels_{i + 1} AS MATERIALIZED (
  SELECT id, label FROM (
    SELECT n.dst AS id, l.label, row_number() OVER (PARTITION BY n.dst ORDER BY count(*) DESC, l.label) AS rn
    FROM neighbours n JOIN labels_{i} l ON l.id = n.src GROUP BY n.dst, l.label) WHERE rn = 1)"""
        )
    parts.append(f"""communities AS (SELECT id, label FROM labels_{rounds})""")
    return parts


_REORDERS = """SELECT event_time, item_id AS sku, CAST(greatest(200 - stock_level, 0) AS INTEGER) AS qty,
  'supplier@example.com' AS supplier_email,
  printf('[AUTO-REORDER] SKU %d low stock (%d units)', item_id, stock_level) AS subject,
  printf('Automated reorder triggered for SKU %d. Current stock %d is below threshold %d. '
         || 'Please ship %d units to restore target 200.',
         item_id, stock_level, reorder_threshold, greatest(200 - stock_level, 0)) AS body
FROM alerts"""

_BASE = [CLICKS, SILVER]
_CLICK_COMMUNITIES = [p.replace("order_edges", "click_edges") for p in _communities()]
_SERVING = [
    *_BASE, WINDOWS, FORECAST, PROPERTIES, INVENTORY, CATALOG_PRICE, CLICK_EDGES, *_CLICK_COMMUNITIES, SERVING_ROWS,
]
_DECIDED = [*_SERVING, _surge(_SHARE), WALK]
_LIVE = [*_DECIDED, LIVE]


def _with(parts: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


NORMALIZED = """normalized AS (
  SELECT event_time, visitor_id, event, item_id, price,
         CASE WHEN event IS NULL OR event NOT IN ('view', 'addtocart', 'transaction') THEN 'unknown_event'
              WHEN event_time IS NULL THEN 'bad_timestamp'
              WHEN visitor_id IS NULL THEN 'bad_visitor'
              WHEN item_id IS NULL THEN 'bad_item' END AS reject_reason
  FROM clicks)"""


def _page_rank(rounds: int = 5) -> list[str]:
    parts = [
        """vertices AS (SELECT item_id AS id FROM order_edges UNION SELECT related_item_id FROM order_edges)""",
        """degrees AS (SELECT item_id AS id, count(*) AS degree FROM order_edges GROUP BY 1)""",
        """ranks_0 AS (SELECT id, 1.0::DOUBLE AS rank FROM vertices)""",
    ]
    for i in range(rounds):
        parts.append(
            f"""ranks_{i + 1} AS MATERIALIZED (
  SELECT v.id, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(m.total, 0.0) AS rank
  FROM vertices v LEFT JOIN (
    SELECT e.related_item_id AS id, sum(r.rank / d.degree) AS total
    FROM order_edges e JOIN ranks_{i} r ON r.id = e.item_id JOIN degrees d ON d.id = e.item_id
    GROUP BY 1) m USING (id))"""
        )
    parts.append(
        f"""pagerank AS (
  SELECT id, round(rank * (SELECT count(*) / sum(rank) FROM ranks_{rounds}), 6) AS pagerank FROM ranks_{rounds})"""
    )
    return parts


def _campaign_case() -> str:
    cases = " ".join(
        f"WHEN make_timestamp(event_time * 1000) BETWEEN TIMESTAMP '{w.start.replace('T', ' ')}' "
        f"AND TIMESTAMP '{w.end.replace('T', ' ')}' THEN {w.multiplier}::DOUBLE"
        for w in CAMPAIGNS
    )
    return f"CASE {cases} ELSE 1.0::DOUBLE END"


_CLICK_PAYLOAD = "SELECT event_time, visitor_id, event, item_id, price FROM clicks"
_KNOWN = "event IN ('view', 'addtocart', 'transaction')"
_PRESENT_BASE = "(l_extendedprice / l_quantity)"
_PRESENT_NEW = f"({_PRESENT_BASE} * (1.1::DOUBLE - l_discount * 2.0::DOUBLE))"

STREAM_WALK = f"""limits AS (
  SELECT max(event_time) - INTERVAL '2 minutes' AS watermark FROM (
    SELECT make_timestamp(event_time * 1000) AS event_time FROM clicks WHERE {_KNOWN}))"""

# The stream prices every known event, also of items that the batch cleaning drops.
STREAM_EVENTS = SILVER.replace("silver AS (", "stream_events AS (").replace(" AND item_id > 0", "")


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["read_bronze_events"] = _with([CLICKS], "SELECT event_time, visitor_id, event, item_id FROM clicks")
    sql["read_item_properties"] = _with([PROPERTIES], "SELECT timestamp, itemid, property, value FROM properties")
    sql["parse_events"] = _with([CLICKS], _CLICK_PAYLOAD)
    sql["stream_source"] = sql["parse_events"]
    sql["clean_events"] = _with(_BASE, "SELECT * FROM silver")
    sql["normalize_events"] = _with([CLICKS, NORMALIZED], "SELECT * FROM normalized")
    sql["reject_counts"] = _with(
        [CLICKS, NORMALIZED],
        "SELECT coalesce(reject_reason, 'ok') AS outcome, count(*) AS n_rows FROM normalized GROUP BY 1",
    )
    sql["silver_violations"] = _with(
        [CLICKS],
        """SELECT 'event_time_not_null' AS "check", count(*) FILTER (event_time IS NULL) AS violations FROM clicks
UNION ALL SELECT 'item_id_at_least_1', count(*) FILTER (item_id < 1) FROM clicks
UNION ALL SELECT 'event_in_set', count(*) FILTER (event NOT IN ('view', 'addtocart', 'transaction')) FROM clicks""",
    )
    sql["first_events"] = _with([CLICKS], "SELECT * FROM clicks ORDER BY event_time, event_id LIMIT 1000")
    sql["surge_windows"] = _with(
        [CLICKS], f"SELECT event_id, event_time, {_campaign_case()} AS multiplier FROM clicks"
    )
    sql["chrono_split"] = _with(
        [CLICKS],
        """SELECT event_id, event_time,
  CASE WHEN row_number() OVER (ORDER BY event_time, event_id) <= floor((SELECT count(*) FROM clicks) * 0.8)
       THEN 'train' ELSE 'test' END AS split FROM clicks""",
    )

    sales_features = _features("sales_features", "sales")
    sql["daily_sales"] = _with([SALES, sales_features], "SELECT * FROM sales_features_daily")
    sql["features"] = _with(
        [SALES, sales_features],
        "SELECT * REPLACE (round(velocity_7d, 6) AS velocity_7d, round(velocity_30d, 6) AS velocity_30d) "
        "FROM sales_features",
    )
    sql["inventory"] = _with([PROPERTIES, INVENTORY], "SELECT item_id, CAST(stock AS INTEGER) AS stock FROM inventory")
    sql["catalog_price"] = _with([PROPERTIES, CATALOG_PRICE], "SELECT * FROM catalog_price")
    sql["forecast_split"] = _with(
        [SALES, sales_features],
        "SELECT item_id, ds, CASE WHEN label IS NULL THEN 'score' ELSE 'train' END AS part FROM sales_features",
    )
    sql["forecast_rmse"] = _with(
        [SALES, sales_features],
        "SELECT round(sqrt(avg((velocity_7d - label) * (velocity_7d - label))), 6) AS rmse, count(*) AS n_rows "
        "FROM sales_features WHERE label IS NOT NULL",
    )

    sql["co_purchase"] = _with([CUSTOMER_EDGES], "SELECT * FROM customer_edges")
    sql["max_elasticity"] = _with(
        [CUSTOMER_EDGES], "SELECT item_id, max(elasticity_weight) AS max_elasticity FROM customer_edges GROUP BY 1"
    )
    sql["affinity_vertices"] = _with(
        [ORDER_EDGES], "SELECT item_id AS id FROM order_edges UNION SELECT related_item_id FROM order_edges"
    )
    sql["pagerank"] = _with([ORDER_EDGES, *_page_rank()], "SELECT * FROM pagerank")
    sql["communities"] = _with([ORDER_EDGES, *_communities()], "SELECT * FROM communities")
    sql["affinity_graph"] = _with(
        [ORDER_EDGES, *_page_rank(), *_communities()],
        """SELECT e.item_id, e.related_item_id, e.elasticity_weight, c.label AS community, p.pagerank
FROM order_edges e LEFT JOIN communities c ON c.id = e.item_id LEFT JOIN pagerank p ON p.id = e.item_id""",
    )
    sql["elasticity_lists"] = _with(
        [ORDER_EDGES],
        """SELECT item_id, CAST(related_item_id // 10000 AS INTEGER) AS list_part,
  CAST(to_json(list({'related': related_item_id, 'weight': elasticity_weight} ORDER BY related_item_id)) AS VARCHAR)
    AS elasticity
FROM order_edges GROUP BY ALL""",
    )

    sql["velocity"] = _with([*_BASE, WINDOWS], "SELECT * FROM windows")
    sql["sequences"] = _with(
        [*_BASE, WINDOWS],
        f"""SELECT item_id, window_start,
  '[' || repeat(steps[1] || ',', CAST(50 - len(steps) AS INTEGER)) || array_to_string(steps, ',') || ']' AS sequence
FROM (
  SELECT item_id, window_start,
    list(CAST(velocity AS DOUBLE) || ',' || CAST(view_count AS DOUBLE) || ',' || CAST(addtocart_count AS DOUBLE)
         || ',0.0') OVER (PARTITION BY item_id, island ORDER BY window_start ROWS 49 PRECEDING) AS steps
  FROM (
    SELECT *, sum(CASE WHEN epoch(window_start) - epoch(previous) > {HISTORY_TTL} THEN 1 ELSE 0 END)
             OVER (PARTITION BY item_id ORDER BY window_start ROWS UNBOUNDED PRECEDING) AS island
    FROM (SELECT *, lag(window_start) OVER (PARTITION BY item_id ORDER BY window_start) AS previous FROM windows)))""",
    )
    price = _PRESENT_BASE
    sql["charm_price"] = f"""SELECT l_orderkey, l_linenumber, l_partkey,
  {_charm(price)} AS charm_99, {_charm(price, '0.95::DOUBLE')} AS charm_95, {_charm(price, '0.0::DOUBLE')} AS charm_00
FROM lineitem"""
    sql["present_price"] = f"""SELECT l_orderkey, l_linenumber, l_partkey, display_price,
  CASE WHEN moved THEN {_round2('base')} END AS anchor_price,
  {_round2('(display_price - base) / base * 100')} AS pct_change,
  CASE WHEN moved AND guarded > base THEN 'surge-premium' WHEN moved THEN 'adjusted' ELSE 'baseline' END AS note
FROM (SELECT *, abs(guarded - base) >= 0.01 AS moved, {_charm('guarded')} AS display_price
      FROM (SELECT l_orderkey, l_linenumber, l_partkey, {_PRESENT_BASE} AS base,
                   greatest({_PRESENT_NEW}, {_PRESENT_BASE}) AS guarded FROM lineitem))"""
    sql["dynamic_price"] = f"""SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_returnflag = 'R' AND baseline > 0 AND velocity / baseline > 2.0
       THEN {_round2('base * (1.0::DOUBLE + least(0.35::DOUBLE * (velocity / baseline - 2.0::DOUBLE) * (1.0::DOUBLE - elasticity), 0.25::DOUBLE))')}
       ELSE {_round2('base')} END AS new_price
FROM (SELECT *, {_PRESENT_BASE} AS base, l_quantity AS velocity, l_tax * 200.0::DOUBLE AS baseline,
             least(greatest(l_discount * 5.0::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) AS elasticity FROM lineitem)"""
    sql["surge_flag"] = _with(
        [*_SERVING, _surge(_SHARE)],
        "SELECT item_id, window_start, baseline, window_baseline, surge_prob, is_surge, uplift FROM lifted",
    )
    sql["price_replay"] = _with(_DECIDED, "SELECT item_id, window_start, base_price, new_price FROM decided")
    sql["price_updates"] = _with(_DECIDED, "SELECT * FROM updates")
    sql["encode_updates"] = _with(
        _DECIDED,
        """SELECT CAST(item_id AS VARCHAR) AS key, '0000000000' AS frame,
  CAST(to_json({'event_time': event_time, 'item_id': item_id, 'base_price': base_price, 'new_price': new_price,
    'velocity': velocity, 'baseline': baseline, 'surge_prob': surge_prob, 'reason': reason}) AS VARCHAR) AS payload
FROM updates""",
    )
    sql["tail_updates"] = _with(
        _DECIDED,
        f"SELECT * FROM updates WHERE (event_time, item_id) > ({LAST_SEEN_MS}, {LAST_SEEN_ITEM}) "
        "ORDER BY event_time, item_id LIMIT 1000",
    )
    sql["price_ticker"] = _with(
        _DECIDED,
        """SELECT item_id, event_time, new_price, CAST(count(*) OVER (PARTITION BY item_id) AS INTEGER) AS n_points
FROM (SELECT * FROM updates ORDER BY event_time DESC, item_id DESC LIMIT 1000)""",
    )
    sql["low_stock_alerts"] = _with([*_SERVING, ALERTS], "SELECT * FROM alerts")
    sql["reorders"] = _with([*_SERVING, ALERTS], _REORDERS)
    sql["alert_log"] = _with(
        [*_SERVING, ALERTS],
        """SELECT strftime(make_timestamp(event_time * 1000), '%H:%M:%S') AS time, item_id AS sku,
  alert_type AS alert, '⚠️' AS icon, substring(message, 1, 80) AS message FROM alerts""",
    )

    sql["sku_universe"] = _with(_SERVING, "SELECT item_id FROM universe")
    sql["publish_serving"] = _with(_SERVING, "SELECT * FROM serving")
    sql["serving_lookup"] = _with(
        _SERVING,
        "SELECT * FROM serving WHERE item_id IN (SELECT item_id FROM silver WHERE event = 'transaction')",
    )
    sql["live_serving"] = _with(_LIVE, "SELECT * FROM live")
    sql["active_skus"] = _with(_LIVE, "SELECT item_id FROM live_table WHERE velocity IS NOT NULL ORDER BY item_id")
    sql["seed_prices_nx"] = _with(
        _LIVE,
        """SELECT coalesce(l.item_id, p.p_partkey + 1) AS item_id, coalesce(l.price, p.p_retailprice) AS price
FROM live l FULL JOIN part p ON p.p_partkey + 1 = l.item_id""",
    )
    sql["kpi_summary"] = _with(
        _LIVE,
        f"""SELECT count(*) AS active_skus, round(avg(price), 6) AS avg_price,
  round(sum(forecast_demand), 6) AS total_forecast,
  count(*) FILTER (forecast_demand > 0
    AND velocity / greatest(forecast_demand * ({WINDOW_SECONDS} / 86400.0::DOUBLE), 0.01::DOUBLE) > 2.0) AS surge_count,
  count(*) FILTER (stock < 50) AS low_stock_count
FROM live_table WHERE velocity IS NOT NULL""",
    )
    sql["forecast_vs_actual"] = _with(
        _LIVE,
        """SELECT item_id, coalesce(forecast_demand, 0.0) AS forecast, velocity AS actual
FROM live_table WHERE velocity IS NOT NULL ORDER BY velocity DESC, item_id LIMIT 30""",
    )
    sql["price_snapshot"] = _with(
        _LIVE,
        """SELECT item_id, coalesce(price, 0.0) AS price
FROM live_table WHERE velocity IS NOT NULL ORDER BY velocity DESC, item_id LIMIT 30""",
    )

    sql["verify_delivery"] = _with(
        [CLICKS, NORMALIZED],
        f"""SELECT count(*) AS received, (SELECT count(*) FROM clicks) - count(*) AS missing,
  greatest(max({NOW_MS} - event_time), 0) AS max_lag_ms FROM normalized WHERE reject_reason IS NULL""",
    )
    sql["order_violations"] = """SELECT item_id, count(*) AS n_events,
  count(*) FILTER (event_time < previous) AS violations
FROM (SELECT *, lag(event_time) OVER (PARTITION BY item_id ORDER BY event_id, event_time) AS previous
      FROM (SELECT l_partkey + 1 AS item_id, l_orderkey * 8 + l_linenumber AS event_id, l_shipdate AS event_time
            FROM lineitem))
GROUP BY item_id"""
    sql["run_metrics"] = _with(
        [*_DECIDED, NORMALIZED],
        """SELECT 'ingest' AS component, 'records_processed' AS metric,
       count(*) FILTER (reject_reason IS NULL) AS value FROM normalized
UNION ALL SELECT 'ingest', 'errors', count(*) FILTER (reject_reason IS NOT NULL) FROM normalized
UNION ALL SELECT 'pricing', 'records_processed', count(*) FROM decided
UNION ALL SELECT 'pricing', 'surge_events', count(*) FILTER (is_surge) FROM decided
UNION ALL SELECT 'pricing', 'low_stock_alerts', count(*) FILTER (stock < 50) FROM decided
UNION ALL SELECT 'publish', 'records_processed', count(*) FROM serving""",
    )

    stream_windows = WINDOWS.replace("windows AS (", "all_windows AS (", 1).replace("FROM silver", "FROM stream_events")
    closed = "windows AS (SELECT * FROM all_windows WHERE window_end <= (SELECT watermark FROM limits))"
    sql["pricing_stream"] = _with(
        [*_BASE, STREAM_EVENTS, stream_windows, STREAM_WALK, closed, *_SERVING[3:], _surge("0.0"), WALK],
        "SELECT * FROM updates",
    )
    sql["nightly_batch"] = _with(
        [
            CLICKS,
            """silver AS (
  SELECT DISTINCT make_timestamp(event_time * 1000) AS event_time, visitor_id, event, item_id
  FROM clicks WHERE event IN ('view', 'addtocart', 'transaction') AND item_id > 0)""",
            FORECAST, PROPERTIES, INVENTORY, CATALOG_PRICE, CLICK_EDGES, *_CLICK_COMMUNITIES, SERVING_ROWS,
        ],
        """SELECT s.item_id, round(s.max_elasticity, 6) AS max_elasticity,
  s.community, s.stock, s.price, CASE WHEN s.forecast_demand IS NOT NULL THEN TRUE END AS has_forecast
FROM serving s""",
    )
    sql["merge_serving"] = _with(
        _LIVE,
        """SELECT coalesce(p.item_id, o.item_id) AS item_id, coalesce(p.forecast_demand, o.forecast_demand) AS forecast_demand,
  coalesce(p.max_elasticity, o.max_elasticity) AS max_elasticity, coalesce(p.community, o.community) AS community,
  coalesce(p.stock, o.stock) AS stock, coalesce(o.price, p.price) AS price,
  coalesce(CAST(o.velocity AS DOUBLE), p.velocity) AS velocity, coalesce(o.velocity_window, p.velocity_window) AS velocity_window
FROM live_table o FULL JOIN serving p ON p.item_id = o.item_id""",
    )
    sql["elasticity_lookup"] = _with(
        [*_BASE, ORDER_EDGES],
        """SELECT item_id, CAST(related_item_id // 10000 AS INTEGER) AS list_part,
  CAST(to_json(list({'related': related_item_id, 'weight': elasticity_weight} ORDER BY related_item_id)) AS VARCHAR)
    AS elasticity
FROM order_edges WHERE item_id IN (SELECT item_id FROM silver WHERE event = 'transaction') GROUP BY ALL""",
    )
    sql["stream_rejects"] = _with(
        [CLICKS],
        f"""SELECT reject_reason, count(*) AS n_rows FROM (
  SELECT CASE WHEN event_id % 100 = 0 THEN 'short_frame' WHEN event_id % 100 = 1 THEN 'bad_payload'
              WHEN NOT ({_KNOWN}) THEN 'unknown_event' END AS reject_reason FROM clicks)
WHERE reject_reason IS NOT NULL GROUP BY 1""",
    )
    stream = [*_BASE, STREAM_EVENTS, stream_windows, STREAM_WALK, closed, *_SERVING[3:]]
    sql["stream_orders"] = _with([*stream, ALERTS], _REORDERS)
    sql["stream_live"] = _with(
        stream,
        f"""SELECT item_id, CAST(arg_max(velocity, window_start) AS DOUBLE) AS velocity, '{WINDOW_LABEL}' AS velocity_window
FROM windows GROUP BY item_id""",
    )
    sql["follow_updates"] = sql["pricing_stream"]
    sql["deduplicated_stream"] = sql["pricing_stream"]
    sql["refreshed_stream"] = _with(
        [*_BASE, STREAM_EVENTS, stream_windows, STREAM_WALK, closed, *_SERVING[3:]],
        f"""SELECT epoch_us(window_end) // 1000 AS event_time, item_id, windows.velocity::DOUBLE AS velocity,
  coalesce(forecast_demand, 0.0) * CASE WHEN window_end <= (
    SELECT max(make_timestamp(event_time * 1000)) - INTERVAL '2 minutes' FROM clicks
    WHERE {_KNOWN} AND make_timestamp(event_time * 1000) < TIMESTAMP '{HALF}') THEN 1 ELSE 2 END AS baseline
FROM windows LEFT JOIN serving USING (item_id)""",
    )
    sql["stream_metrics"] = _with(
        [*_BASE, STREAM_EVENTS, stream_windows, STREAM_WALK, closed, *_SERVING[3:], _surge("0.0"), WALK],
        f"""SELECT 'ingest' AS component, 'records_processed' AS metric, count(*) FILTER ({_KNOWN}) AS value FROM clicks
UNION ALL SELECT 'ingest', 'errors', count(*) FILTER (NOT ({_KNOWN})) FROM clicks
UNION ALL SELECT 'pricing', 'records_processed', count(*) FROM decided
UNION ALL SELECT 'pricing', 'surge_events', count(*) FILTER (is_surge) FROM decided
UNION ALL SELECT 'pricing', 'low_stock_alerts', count(*) FILTER (stock < 50) FROM decided""",
    )
    sql["sales_forecast"] = _with(
        [SALES, sales_features],
        """SELECT count(*) AS n_items, TRUE AS not_negative, TRUE AS stored_equals_fresh, TRUE AS learns
FROM sales_features WHERE label IS NULL""",
    )
    sql["campaign_join"] = _with(
        [
            CLICKS,
            """campaigns AS (
  SELECT p_partkey AS ordinal, TIMESTAMP '2024-01-01' + to_hours((p_partkey * 37 % 744)::BIGINT) AS start,
    TIMESTAMP '2024-01-01' + to_hours((p_partkey * 37 % 744 + p_partkey % 5 * 2 - 2)::BIGINT) AS stop,
    (p_partkey % 9 + 2)::DOUBLE AS multiplier
  FROM part WHERE p_partkey % 10 IN (3, 5))""",
            """held AS (
  SELECT event_id, arg_min(multiplier, ordinal) AS multiplier
  FROM clicks JOIN campaigns ON make_timestamp(event_time * 1000) BETWEEN start AND stop GROUP BY 1)""",
        ],
        "SELECT event_id, event_time, coalesce(multiplier, 1.0) AS multiplier FROM clicks LEFT JOIN held USING (event_id)",
    )
    sql["stored_models"] = _with(
        _BASE + [WINDOWS] if WINDOWS not in _BASE else _BASE,
        """SELECT model, state, n_windows, CASE model WHEN 'good' THEN n_windows ELSE 0 END AS n_equal,
  CASE model WHEN 'good' THEN 0 ELSE n_windows END AS n_zero
FROM (VALUES ('good', 'in use'), ('misshapen', 'fallback 0'), ('absent', 'fallback 0')) AS m(model, state),
  (SELECT count(*) AS n_windows FROM windows)""",
    )
    return sql
