"""SQL for the registered queries, to be run by DuckDB over the same tables."""

_DAILY = """
bars AS (
  SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS dt,
    CAST(first(o_totalprice ORDER BY o_orderdate, o_orderkey) AS FLOAT) AS open,
    CAST(max(o_totalprice) AS FLOAT) AS high,
    CAST(min(o_totalprice) AS FLOAT) AS low,
    CAST(last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS FLOAT) AS close,
    CAST(count(*) AS BIGINT) AS volume,
    CAST(epoch_ms(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) AS BIGINT) AS timestamp_in_ms
  FROM orders GROUP BY 1, 2, 8)"""

_MINUTES = """
minutes AS (
  SELECT event_type AS series, date_trunc('minute', ts) AS ts,
    first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
    last(value ORDER BY ts, event_id) AS close, CAST(count(*) AS BIGINT) AS volume
  FROM events GROUP BY event_type, date_trunc('minute', events.ts))"""

_INTRADAY = _MINUTES + """,
intraday AS (
  SELECT series, CAST(ts AS DATE) AS dt, CAST(open AS FLOAT) AS open, CAST(high AS FLOAT) AS high,
    CAST(low AS FLOAT) AS low, CAST(close AS FLOAT) AS close, volume,
    CAST(epoch_ms(ts) AS BIGINT) AS timestamp_in_ms
  FROM minutes)"""


def _gold(source: str, order: str) -> str:
    return f"""
gold AS (
  SELECT series, dt, open, high, low, ln(1 + CAST(close AS DOUBLE)) AS close, volume, timestamp_in_ms,
    open AS ave_open, high AS ave_high, low AS ave_low, ln(1 + CAST(close AS DOUBLE)) AS ave_close,
    volume AS total_volume,
    avg(CAST(close AS DOUBLE)) OVER (PARTITION BY series ORDER BY {order} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS ma,
    CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month, CAST(day(dt) AS INTEGER) AS "date"
  FROM {source})"""


_DAILY_GOLD = _DAILY + "," + _gold("bars", "dt")


def _r(column: str, digits: int, name: str | None = None) -> str:
    return f"round(CAST({column} AS DOUBLE), {digits}) AS {name or column}"


def _day(column: str = "dt", name: str | None = None) -> str:
    return f"CAST(CAST({column} AS DATE) AS VARCHAR) AS {name or column}"


def _clock(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


def _bar_columns(digits: int) -> str:
    prices = ", ".join(_r(c, digits) for c in ("open", "high", "low", "close"))
    return f"series, {_day()}, {prices}, volume, timestamp_in_ms"


def _gold_columns(digits: int) -> str:
    logged = ", ".join(_r(c, digits) for c in ("open", "high", "low", "close", "ave_open", "ave_high", "ave_low", "ave_close"))
    return f'series, {_day()}, {logged}, volume, timestamp_in_ms, total_volume, {_r("ma", digits, chr(34) + "30_day_ma_close" + chr(34))}, year, month, "date"'


def _minute_columns(clock: str = "ts") -> str:
    prices = ", ".join(_r(c, 6) for c in ("open", "high", "low", "close"))
    return f"series, {_clock(clock)}, {prices}, volume"


_SPLIT = _DAILY_GOLD + """,
placed AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY dt DESC) AS age FROM gold),
split AS (SELECT *, CASE WHEN age <= 100 THEN 'test' WHEN age <= 200 THEN 'validation' ELSE 'train' END AS split FROM placed)"""

_CANDIDATES = """,
scored AS (SELECT *, ln(1 + ma) AS pred_mean, ln(1 + CAST(open AS DOUBLE)) AS pred_open,
  ln(1 + (CAST(high AS DOUBLE) + CAST(low AS DOUBLE)) / 2) AS pred_mid FROM {source})"""

_UPSERTED = _DAILY + """,
source AS (SELECT * REPLACE (CAST(CAST(close AS DOUBLE) + 1 AS FLOAT) AS close) FROM bars WHERE dt >= DATE '1999-07-01'),
target AS (SELECT * FROM bars WHERE dt < DATE '2000-01-01'),
merged AS (
  SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.series = t.series AND s.dt = t.dt)
  UNION ALL SELECT * FROM source)"""

_DAMAGED = _DAILY + """,
damaged AS (
  SELECT *, CAST(day(dt) AS INTEGER) AS d,
    CASE WHEN day(dt) = 14 THEN CAST(dt AS VARCHAR) || 'x' ELSE CAST(dt AS VARCHAR) END AS dt_string
  FROM bars)"""

_FOLDS = _DAILY_GOLD + """,
indexed AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY dt) - 1 AS row_idx, count(*) OVER (PARTITION BY series) AS n
  FROM gold),
folds AS (
  SELECT series, CAST(unnest(generate_series(0, (n - 160) // 50)) AS BIGINT) AS fold
  FROM (SELECT DISTINCT series, n FROM indexed)),
folded AS (
  SELECT i.*, f.fold, CASE WHEN row_idx < f.fold * 50 + 100 THEN 'train' ELSE 'validation' END AS role
  FROM indexed i JOIN folds f ON i.series = f.series
  WHERE (row_idx >= f.fold * 50 AND row_idx < f.fold * 50 + 100)
     OR (row_idx >= f.fold * 50 + 110 AND row_idx < f.fold * 50 + 160)),
fits AS (
  SELECT series, fold, regr_slope(close, open / 100000.0) AS slope, regr_intercept(close, open / 100000.0) AS intercept
  FROM (SELECT series, fold, role, close, CAST(open AS DOUBLE) AS open FROM folded) WHERE role = 'train' GROUP BY 1, 2)"""

def _descent(epochs: int, configs: int, shown: str) -> str:
    """Gradient descent of every fold and configuration on the sums of its rows, epoch by epoch, with early stopping.

    `walk` has the weights, the best loss so far and its weights; `scored` the means over folds after the epochs `shown`.
    """
    p = range(4)
    upper = [(i, j) for i in p for j in p if i <= j]
    a = lambda i, j: f"a{min(i, j)}{max(i, j)}"
    sums = ", ".join([f"sum(x{i} * x{j}) AS a{i}{j}" for i, j in upper] + [f"sum(x{i} * y) AS b{i}" for i in p])
    gradient = ", ".join(
        f"2.0 * ({' + '.join(f't.{a(i, j)} * w{j}' for j in p)} - t.b{i}) / t.n" + (f" + 2.0 * l2 * w{i}" if i < 3 else "") + f" AS g{i}" for i in p
    )
    moved = ", ".join(f"CASE WHEN going THEN w{i} - rate * least(1.0, 1.0 / greatest(norm, 1.0)) * g{i} ELSE w{i} END AS w{i}" for i in p)
    quadratic = " + ".join(f"w{i} * ({' + '.join(f'v.{a(i, j)} * w{j}' for j in p)})" for i in p)
    loss = f"greatest((v.yy - 2 * ({' + '.join(f'w{i} * v.b{i}' for i in p)}) + {quadratic}) / v.n, 0.0)"
    of = "series, fold, config_id, rate, l2"
    unit = lambda label: f"CAST('0x' || substr(md5(i || ':0:{label}'), 1, 7) AS BIGINT) / 268435456.0"
    return f"""
points AS (
  SELECT series, fold, role, CAST(open AS DOUBLE) / 100000.0 AS x0, CAST(high AS DOUBLE) / 100000.0 AS x1,
    CAST(low AS DOUBLE) / 100000.0 AS x2, 1.0::DOUBLE AS x3, close AS y FROM folded),
sums AS (SELECT series, fold, role, count(*) AS n, {sums}, sum(y * y) AS yy FROM points GROUP BY 1, 2, 3),
t AS (SELECT * FROM sums WHERE role = 'train'),
v AS (SELECT * FROM sums WHERE role = 'validation'),
configs AS (SELECT i AS config_id, {unit("rate")} * (1e-2 - 1e-5) + 1e-5 AS rate, pow(10.0, {unit("l2")} * 6 - 4) AS l2 FROM range({configs}) AS r(i)),
walk AS (
  SELECT {of}, 0 AS epoch, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, t.b3 / t.n AS w3, 'inf'::DOUBLE AS loss,
    'inf'::DOUBLE AS best, 0 AS misses, TRUE AS going, [0.0::DOUBLE] AS kept FROM t, configs
  UNION ALL
  SELECT {of}, epoch, w0, w1, w2, w3, loss, CASE WHEN better THEN loss ELSE best END,
    CASE WHEN better THEN 0 WHEN going THEN misses + 1 ELSE misses END, going AND (better OR misses + 1 < 10),
    CASE WHEN better THEN [w0, w1, w2, w3] ELSE kept END
  FROM (
    SELECT *, going AND loss + 1e-5 < best AS better FROM (
      SELECT s.*, {loss} AS loss FROM (
        SELECT {of}, epoch, best, misses, going, kept, {moved} FROM (
          SELECT *, sqrt(g0 * g0 + g1 * g1 + g2 * g2 + g3 * g3) AS norm FROM (
            SELECT walk.series, walk.fold, config_id, rate, l2, epoch + 1 AS epoch, best, misses, going, kept, w0, w1, w2, w3, {gradient}
            FROM walk JOIN t ON t.series = walk.series AND t.fold = walk.fold WHERE epoch < {epochs}))
      ) s JOIN v ON v.series = s.series AND v.fold = s.fold))),
shown AS (SELECT * FROM walk WHERE epoch IN ({shown})),
missed AS (
  SELECT config_id, epoch, s.series, s.fold, any_value(best) AS mse, exp(avg(abs(kept[1] * x0 + kept[2] * x1 + kept[3] * x2 + kept[4] - y))) AS mae_ratio
  FROM shown s JOIN points q ON q.series = s.series AND q.fold = s.fold AND q.role = 'validation' GROUP BY 1, 2, 3, 4),
scored AS (SELECT config_id, epoch, avg(mse) AS mse, avg(mae_ratio) AS mae_ratio FROM missed GROUP BY 1, 2)"""


def _halving(rounds: int) -> str:
    """Rounds of the published schedule for a budget of 27 and a factor of 3, all brackets at a time."""
    ranked = "row_number() OVER (PARTITION BY b.bracket ORDER BY s.mse, b.config_id) AS k, count(*) OVER (PARTITION BY b.bracket) AS n"
    parts = [f"""
brackets AS (
  SELECT CAST(CASE WHEN i < 27 THEN 3 WHEN i < 39 THEN 2 WHEN i < 45 THEN 1 ELSE 0 END AS INTEGER) AS bracket, i AS config_id FROM range(49) AS r(i)),
r0 AS (
  SELECT b.*, s.mse, s.mae_ratio, s.epoch AS budget, {ranked} FROM brackets b
  JOIN scored s ON s.config_id = b.config_id AND s.epoch = 27 // CAST(pow(3, bracket) AS INTEGER))"""]
    for i in range(1, rounds):
        parts.append(f"""
r{i} AS (
  SELECT b.bracket, b.config_id, s.mse, s.mae_ratio, s.epoch AS budget, {ranked}
  FROM r{i - 1} b JOIN scored s ON s.config_id = b.config_id AND s.epoch = 3 * b.budget WHERE b.k <= b.n // 3 AND b.bracket >= {i})""")
    return ",".join(parts)


def _stumps(trees: int) -> str:
    """Boosted trees of depth 1 per fold position: every split of every feature tried, ties to the first feature and edge."""
    parts = ["""edges AS (
  SELECT f, e, row_number() OVER (PARTITION BY f ORDER BY e) AS k FROM (
    SELECT DISTINCT f, unnest(quantile_disc(x, [i / 32.0 FOR i IN range(1, 32)])) AS e FROM (
      SELECT unnest([0, 1, 2]) AS f, unnest([CAST(open AS DOUBLE), CAST(high AS DOUBLE), CAST(low AS DOUBLE)]) / 100000.0 AS x FROM gold)
    GROUP BY f)),
base AS (
  SELECT row_number() OVER () AS id, fold, role, close AS y,
    [CAST(open AS DOUBLE) / 100000.0, CAST(high AS DOUBLE) / 100000.0, CAST(low AS DOUBLE) / 100000.0] AS x FROM folded),
p0 AS (SELECT *, 0.0::DOUBLE AS pred FROM base)"""]
    for t in range(1, trees + 1):
        weight = "1.0" if t == 1 else "0.1"
        parts.append(f"""
cut{t} AS (
  SELECT p.fold, f, k, e, count(*) FILTER (x[f + 1] <= e) AS nl, sum(y - pred) FILTER (x[f + 1] <= e) AS sl, count(*) AS n, sum(y - pred) AS s
  FROM p{t - 1} p, edges WHERE role = 'train' GROUP BY p.fold, f, k, e),
gain{t} AS (
  SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) - s * s / n AS gain FROM cut{t} WHERE nl > 0 AND nl < n),
best{t} AS (
  SELECT * FROM (SELECT *, max(gain) OVER (PARTITION BY fold) AS top FROM gain{t}) WHERE gain >= top * (1 - 1e-9)
  QUALIFY row_number() OVER (PARTITION BY fold ORDER BY f, k) = 1),
p{t} AS (
  SELECT p.id, p.fold, role, y, x, pred + {weight} * CASE WHEN x[f + 1] <= e THEN sl / nl ELSE (s - sl) / (n - nl) END AS pred
  FROM p{t - 1} p JOIN best{t} b ON b.fold = p.fold),
m{t} AS (SELECT fold, avg(pow(y - pred, 2)) AS m, avg(abs(y - pred)) AS a FROM p{t} WHERE role = 'validation' GROUP BY 1)""")
    best, joined = "m1.m", "m1"
    mae = "m1.a"
    for t in range(2, trees + 1):
        better = f"m{t}.m + 1e-5 < {best}"
        best, mae = f"CASE WHEN {better} THEN m{t}.m ELSE {best} END", f"CASE WHEN {better} THEN m{t}.a ELSE {mae} END"
        joined += f" JOIN m{t} USING (fold)"
    parts.append(f"\nper AS (SELECT fold, {best} AS mse, exp({mae}) AS mae_ratio FROM {joined})")
    return ",".join(parts)


_SAMPLES = """
samples AS (
  SELECT event_type, value, CAST(user_id AS DOUBLE) AS user_id,
    CASE WHEN ts < TIMESTAMP '2024-01-21' THEN 1 ELSE 0 END AS r FROM events)"""


def _ks(long_rows: str, keys: str) -> str:
    return f"""
long_rows AS ({long_rows}),
counted AS (SELECT {keys}, v, sum(r) AS nr, sum(1 - r) AS nc FROM long_rows GROUP BY {keys}, v),
steps AS (
  SELECT {keys}, sum(nr) OVER w AS cr, sum(nc) OVER w AS cc,
    sum(nr) OVER (PARTITION BY {keys}) AS tr, sum(nc) OVER (PARTITION BY {keys}) AS tc
  FROM counted WINDOW w AS (PARTITION BY {keys} ORDER BY v)),
ks AS (
  SELECT {keys}, CAST(max(tr) AS BIGINT) AS n_ref, CAST(max(tc) AS BIGINT) AS n_cur,
    max(abs(cr / tr - cc / tc)) AS statistic FROM steps GROUP BY {keys}),
lam AS (SELECT *, statistic * sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) AS l FROM ks),
tested AS (
  SELECT {keys}, n_ref, n_cur, statistic, CASE WHEN l < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0,
    2 * list_sum([CASE WHEN j % 2 = 1 THEN 1.0 ELSE -1.0 END * exp(-2.0 * j * j * l * l) FOR j IN range(1, 101)]))) END AS p_value
  FROM lam)"""


_KS_TWO = "WITH " + _SAMPLES + "," + _ks(
    "SELECT 'value' AS \"column\", value AS v, r FROM samples UNION ALL SELECT 'user_id', user_id, r FROM samples", '"column"'
) + """
SELECT "column", n_ref, n_cur, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value,
  CASE WHEN p_value < 0.05 THEN 'drift' ELSE 'stable' END AS flag FROM tested"""


def _quality(keys: str, tables: str = _DAILY_GOLD, source: str = "gold") -> str:
    select = f"{keys}, " if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return "WITH " + tables + f""",
m AS (SELECT {select} count(*) AS n, count(close) AS c, count(volume) AS v, min(open) AS lo, max(volume) AS hi FROM {source} {group}),
rules AS (
  SELECT {select} 'size' AS constraint_name, CAST(NULL AS VARCHAR) AS column_name, CAST(n AS DOUBLE) AS value, n > 0 AS ok FROM m
  UNION ALL SELECT {select} 'completeness', 'close', c / n, c = n FROM m
  UNION ALL SELECT {select} 'completeness', 'volume', v / n, v = n FROM m
  UNION ALL SELECT {select} 'min', 'open', CAST(lo AS DOUBLE), lo > 0 FROM m
  UNION ALL SELECT {select} 'max', 'volume', CAST(hi AS DOUBLE), hi < 10000000000 FROM m)
SELECT {select} 'Weekly Stock Data Check' AS "check", 'Warning' AS level, constraint_name AS "constraint",
  column_name AS "column", round(value, 3) AS value, CASE WHEN ok THEN 'Success' ELSE 'Failure' END AS status FROM rules"""


def _filled(column: str, group: str, alias: str) -> str:
    return f"""
med_{alias} AS (SELECT {group or "1"} AS g, median(CAST({column} AS DOUBLE)) AS med FROM gapped WHERE split = 'train' GROUP BY 1),
fit_{alias} AS (
  SELECT m.g, m.med, avg(coalesce(CAST({column} AS DOUBLE), m.med)) AS mean, stddev_pop(coalesce(CAST({column} AS DOUBLE), m.med)) AS std
  FROM gapped x JOIN med_{alias} m ON m.g = {"x." + group if group else "1"} WHERE split = 'train' GROUP BY 1, 2)"""


def _scaled(columns: dict[str, str], group: str) -> str:
    fits = ",".join(_filled(c, group, a) for a, c in columns.items())
    out = ", ".join(
        f"round((coalesce(CAST(x.{c} AS DOUBLE), {a}.med) - {a}.mean) / {a}.std, 6) AS {'\"30_day_ma_close\"' if c == 'ma' else c}"
        for a, c in columns.items()
    )
    joins = " ".join(f"JOIN fit_{a} {a} ON {a}.g = {'x.' + group if group else '1'}" for a in columns)
    return "WITH " + _SPLIT + f""",
gapped AS (SELECT * REPLACE (CASE WHEN day(dt) = 7 THEN NULL ELSE volume END AS volume) FROM split),{fits}
SELECT x.series, CAST(x.dt AS VARCHAR) AS dt, {out} FROM gapped x {joins}"""


def _codes(column: str) -> str:
    return f"""
code_{column} AS (
  SELECT series, c, row_number() OVER (PARTITION BY series ORDER BY f, CAST(c AS VARCHAR)) AS code
  FROM (SELECT series, "{column}" AS c, min(dt) AS f FROM split WHERE split = 'train' GROUP BY 1, 2)),
width_{column} AS (SELECT CAST(ceil(log2(max(code) + 1)) AS INTEGER) AS b FROM code_{column})"""


def _bits(column: str, n: int) -> str:
    return ", ".join(f"CAST((coalesce(c_{column}.code, 0) >> ((SELECT b FROM width_{column}) - 1 - {i})) & 1 AS INTEGER) AS {column}_{i}" for i in range(n))


_RECORDS = _INTRADAY + """,
sent AS (SELECT *, CAST(hour(make_timestamp(timestamp_in_ms * 1000)) AS INTEGER) AS h FROM intraday)"""

_UPSERT_OUT = "WITH " + _UPSERTED + f" SELECT {_bar_columns(3)} FROM merged"

# Micro-batch of an event, as the queries land them.
_PART = """CASE WHEN ts >= TIMESTAMP '2024-01-21 12:00:30' THEN 2
  WHEN ts >= TIMESTAMP '2024-01-21 11:00:30' AND event_id % 2 = 0 THEN 2
  WHEN ts >= TIMESTAMP '2024-01-11 00:00:30' THEN 1 ELSE 0 END"""


def _ridge_on_open(rows: str) -> str:
    """Ridge of the close on the scaled opening price: fitted on all but the newest 100 rows of each series in `rows`."""
    return f"""
aged AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY dt DESC) AS k FROM {rows}),
scale AS (SELECT avg(CAST(open AS DOUBLE)) AS mu, stddev_pop(CAST(open AS DOUBLE)) AS sd FROM aged WHERE k > 100),
z AS (SELECT g.*, (CAST(open AS DOUBLE) - mu) / sd AS z FROM gold g, scale),
model AS (
  SELECT sum((z.z) * (z.close - m.my)) / (sum(z.z * z.z) + 5.0) AS w, any_value(m.my) AS b
  FROM z JOIN aged a ON a.series = z.series AND a.dt = z.dt AND a.k > 100, (SELECT avg(close) AS my FROM aged WHERE k > 100) m)"""


def _online_step(before: str, batch: int) -> str:
    """One squared-error step at rate 0.05 from the weights of the step before, on the moments of a micro-batch."""
    return f"""SELECT m.*, p.w - 0.1 * (p.w * m.xx + p.b * m.x - m.xy) AS w, p.b - 0.1 * (p.w * m.x + p.b - m.y) AS b,
  p.w * p.w * m.xx + 2 * p.w * p.b * m.x + p.b * p.b - 2 * p.w * m.xy - 2 * p.b * m.y + m.yy AS mse
  FROM m JOIN {before} AS p ON p.series = m.series WHERE m.batch_id = {batch}"""


def _stream_learn() -> str:
    """Three online steps on replayed bars: the bars as they stand after each micro-batch, the buffer of the last 300 sent, four drawn."""
    columns = ("open", "high", "low", "ma")
    scale = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m{i}, stddev_pop(CAST({c} AS DOUBLE)) AS d{i}" for i, c in enumerate(columns))
    scaled = ", ".join(f"(CAST(g.{c} AS DOUBLE) - m{i}) / d{i} AS x{i}" for i, c in enumerate(columns))
    zeros = ", ".join(f"0.0::DOUBLE AS w{i}" for i in range(5))
    error = " + ".join([f"w{i} * x{i}" for i in range(4)] + ["w4 - y"])
    sums = ", ".join([f"2 * avg(e * x{i}) AS g{i}" for i in range(4)] + ["2 * avg(e) AS g4"])
    norm = "sqrt(" + " + ".join(f"g{i} * g{i}" for i in range(5)) + ")"
    moved = ", ".join(f"CASE WHEN u.n IS NULL THEN w{i} ELSE w{i} - 0.01 * g{i} * least(1.0, 1.0 / {norm}) END AS w{i}" for i in range(5))
    steps = "".join(f""",
s{b + 1} AS (
  SELECT s.series, {moved}, s.steps + CASE WHEN u.n IS NULL THEN 0 ELSE 1 END AS steps, u.n, u.mse, {b} AS batch_id FROM s{b} s LEFT JOIN (
    SELECT series, count(*) AS n, avg(e * e) AS mse, {sums} FROM (
      SELECT x.*, {error} AS e FROM x JOIN s{b} p ON p.series = x.series WHERE b = {b}) GROUP BY 1) u ON u.series = s.series)""" for b in range(3))
    return "WITH " + _INTRADAY + "," + _gold("intraday", "dt, timestamp_in_ms") + f""",
scale AS (SELECT {scale} FROM gold),
states AS (
  SELECT b, event_type AS series, date_trunc('minute', ts) AS m, first(value ORDER BY ts, event_id) AS open, max(value) AS high,
    min(value) AS low, last(value ORDER BY ts, event_id) AS close, max(CASE WHEN part = b THEN 1 ELSE 0 END) AS sent
  FROM (SELECT *, {_PART} AS part FROM events) e, range(3) AS t(b) WHERE part <= b GROUP BY ALL),
stood AS (
  SELECT b, series, sent, CAST(epoch_ms(m) AS BIGINT) AS ms, CAST(open AS FLOAT) AS open, CAST(high AS FLOAT) AS high, CAST(low AS FLOAT) AS low,
    ln(1 + CAST(CAST(close AS FLOAT) AS DOUBLE)) AS y,
    avg(CAST(CAST(close AS FLOAT) AS DOUBLE)) OVER (PARTITION BY b, series ORDER BY m ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS ma
  FROM states),
arrived AS (
  SELECT t.b, series, ms, row_number() OVER (PARTITION BY t.b, series ORDER BY s.b DESC, ms DESC) AS age
  FROM stood s, range(3) AS t(b) WHERE sent = 1 AND s.b <= t.b),
drawn AS (
  SELECT *, row_number() OVER (PARTITION BY b, series ORDER BY age > 1, md5(ms || ':' || b), ms) AS draw,
    count(*) OVER (PARTITION BY b, series) AS held FROM arrived WHERE age <= 300),
x AS (
  SELECT g.b, g.series, y, {scaled} FROM stood g, scale
  WHERE EXISTS (SELECT 1 FROM drawn d WHERE d.b = g.b AND d.series = g.series AND d.ms = g.ms AND draw <= 4 AND held >= 4)),
s0 AS (SELECT DISTINCT event_type AS series, {zeros}, 0 AS steps, NULL::BIGINT AS n, NULL::DOUBLE AS mse, -1 AS batch_id FROM events){steps}
SELECT CAST(batch_id AS BIGINT) AS batch_id, series, CAST(steps AS BIGINT) AS steps, n AS "rows", round(mse, 6) AS mse
FROM (FROM s1 UNION ALL FROM s2 UNION ALL FROM s3) WHERE n IS NOT NULL"""


ORACLES = {
    "daily_bars": "WITH " + _DAILY + f" SELECT {_bar_columns(3)} FROM bars",
    "minute_bars": "WITH " + _MINUTES + f" SELECT {_minute_columns()} FROM minutes",
    "silver_roundtrip": "WITH " + _DAILY + f" SELECT {_bar_columns(3)} FROM bars",
    "silver_rejects": "WITH " + _DAMAGED + """
SELECT series, dt_string, CASE WHEN d = 14 THEN 'bad date' ELSE 'missing or bad field' END AS reason
FROM damaged WHERE d IN (13, 14, 15)""",
    "silver_kept": "WITH " + _DAMAGED + f""",
kept AS (SELECT * REPLACE (CASE WHEN d = 16 THEN 3000000000 ELSE volume END AS volume) FROM damaged WHERE d NOT IN (13, 14, 15))
SELECT {_bar_columns(3)} FROM kept""",
    "gold_features": "WITH " + _DAILY_GOLD + f" SELECT {_gold_columns(4)} FROM gold ORDER BY dt, series",
    "gold_latest": "WITH " + _DAILY_GOLD + f"""
SELECT {_gold_columns(4)} FROM gold g WHERE g.dt = (SELECT max(b.dt) FROM bars b WHERE b.series = g.series)""",
    "gold_halo_window": "WITH " + _INTRADAY + "," + _gold("intraday", "dt, timestamp_in_ms") + f" SELECT {_gold_columns(4)} FROM gold",
    "short_series": """
SELECT o_custkey, o_orderkey, CASE WHEN k <= 3 THEN 'test' WHEN k <= 6 THEN 'validation' ELSE 'train' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
WHERE n > 6""",
    "series_left_out": "SELECT o_custkey, count(*) AS n, CAST(7 AS BIGINT) AS needed FROM orders GROUP BY 1 HAVING count(*) < 7",
    "weekly_production": "WITH " + _DAILY_GOLD + "," + _ridge_on_open("gold") + """
SELECT z.series, CAST(z.dt AS VARCHAR) AS dt, 'ridge' AS candidate, round(w * z.z + b, 6) AS pred
FROM z JOIN aged a ON a.series = z.series AND a.dt = z.dt, model WHERE a.k <= 50""",
    "stream_from_production": "WITH " + _DAILY_GOLD + """,
placed AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY dt DESC) - 1 AS age FROM gold),
early AS (SELECT * FROM placed WHERE age >= 60),""" + _ridge_on_open("early") + """,
m AS (
  SELECT z.series, CASE WHEN age >= 30 THEN 0 ELSE 1 END AS batch_id, count(*) AS n, avg(z) AS x, avg(z * z) AS xx, avg(z * z.close) AS xy,
    avg(z.close) AS y, avg(z.close * z.close) AS yy FROM z JOIN placed p ON p.series = z.series AND p.dt = z.dt WHERE age < 60 GROUP BY 1, 2),
s0 AS (SELECT m.*, w0.w - 0.02 * (w0.w * xx + w0.b * x - xy) AS w, w0.b - 0.02 * (w0.w * x + w0.b - y) AS b,
  w0.w * w0.w * xx + 2 * w0.w * w0.b * x + w0.b * w0.b - 2 * w0.w * xy - 2 * w0.b * y + yy AS mse, 1 AS steps FROM m, model w0 WHERE batch_id = 0),
s1 AS (SELECT m.*, p.w - 0.02 * (p.w * m.xx + p.b * m.x - m.xy) AS w, p.b - 0.02 * (p.w * m.x + p.b - m.y) AS b,
  p.w * p.w * m.xx + 2 * p.w * p.b * m.x + p.b * p.b - 2 * p.w * m.xy - 2 * p.b * m.y + m.yy AS mse, 2 AS steps
  FROM m JOIN s0 p ON p.series = m.series WHERE m.batch_id = 1)
SELECT CAST(batch_id AS BIGINT) AS batch_id, series, round(w, 6) AS w, round(b, 6) AS b, CAST(steps AS BIGINT) AS steps, n, round(mse, 6) AS mse
FROM (FROM s0 UNION ALL FROM s1)""",
    "gold_late_bars": "WITH " + _DAILY_GOLD + f"""
SELECT {_gold_columns(4)} FROM gold QUALIFY row_number() OVER (PARTITION BY series ORDER BY gold.dt) BETWEEN 200 AND 229""",
    "gold_empty": "WITH " + _DAILY_GOLD + f" SELECT {_gold_columns(6)} FROM gold WHERE close < 0",
    "latest_dates": "WITH " + _DAILY + " SELECT series, CAST(max(dt) AS VARCHAR) AS latest_dt FROM bars GROUP BY 1",
    "lakehouse_run": "WITH " + _DAILY_GOLD + f" SELECT {_gold_columns(4)} FROM gold",
    "lakehouse_overlap": "WITH " + _DAILY_GOLD + f" SELECT {_gold_columns(4)} FROM gold",
    "landing_replaced": "WITH " + _DAILY + " SELECT series, CAST(max(dt) AS VARCHAR) AS dt FROM bars GROUP BY series, year(dt)",
    "nan_rejects": "WITH " + _DAILY + """
SELECT series, CAST(dt AS VARCHAR) AS dt_string, 'missing or bad field' AS reason FROM bars WHERE day(dt) IN (13, 14)""",
    "table_from_nothing": "WITH " + _DAILY_GOLD + f" SELECT {_gold_columns(6)} FROM gold WHERE close < 0",
    "ks_drift_default": _KS_TWO,
    "drift_untested": """
SELECT 'value' AS "column", count(*) AS n_ref, CAST(0 AS BIGINT) AS n_cur, CAST(NULL AS DOUBLE) AS statistic,
  CAST(NULL AS DOUBLE) AS p_value, 'untested' AS flag FROM events WHERE ts < TIMESTAMP '2024-01-21'""",
    "upsert_bars": _UPSERT_OUT,
    "upsert_twice": _UPSERT_OUT,
    "create_or_upsert": "WITH " + _DAILY + f" SELECT {_bar_columns(3)} FROM bars",
    "append_copy": "WITH " + _DAILY + " SELECT series, 2 * count(*) AS n, count(DISTINCT dt) AS days FROM bars GROUP BY 1",
    "quality_report": _quality(""),
    "quality_by_series": _quality("series"),
    "quality_refreshed": _quality("series", _UPSERTED, "merged"),
    "ks_drift": _KS_TWO,
    "ks_drift_ranged": _KS_TWO,
    "drift_flags": "WITH " + _SAMPLES + "," + _ks("SELECT event_type, value AS v, r FROM samples", "event_type") + """
SELECT event_type, 'value' AS "column", CASE WHEN p_value < 0.05 THEN 'drift' ELSE 'stable' END AS flag FROM tested""",
    # Five event types leave four degrees of freedom, for which the tail has a closed form.
    "chi2_drift": "WITH " + _SAMPLES + """,
cells AS (SELECT event_type, CAST(sum(r) AS DOUBLE) AS nr, CAST(sum(1 - r) AS DOUBLE) AS nc FROM samples GROUP BY 1),
t AS (SELECT sum(nr) AS tr, sum(nc) AS tc, count(*) - 1 AS k FROM cells),
e AS (SELECT nr, nc, tr * (nr + nc) / (tr + tc) AS er, tc * (nr + nc) / (tr + tc) AS ec, k FROM cells, t),
s AS (SELECT max(k) AS freedom, sum((nr - er) * (nr - er) / er + (nc - ec) * (nc - ec) / ec) AS statistic FROM e),
p AS (SELECT *, exp(-statistic / 2) * (1 + statistic / 2) AS p_value FROM s)
SELECT 'event_type' AS "column", CAST(freedom AS BIGINT) AS freedom, round(statistic, 6) AS statistic,
  round(p_value, 6) AS p_value, CASE WHEN p_value < 0.05 THEN 'drift' ELSE 'stable' END AS flag FROM p""",
    "chrono_split": "WITH " + _SPLIT + " SELECT series, CAST(dt AS VARCHAR) AS dt, split FROM split",
    "split_counts": "WITH " + _SPLIT + """
SELECT series, split, count(*) AS n, CAST(min(dt) AS VARCHAR) AS first_dt, CAST(max(dt) AS VARCHAR) AS last_dt FROM split GROUP BY 1, 2""",
    "impute_scale": _scaled({"o": "open", "v": "volume", "m": "ma"}, ""),
    "impute_scale_by_series": _scaled({"o": "open", "v": "volume"}, "series"),
    "exact_median": """
SELECT l_returnflag, round(median(l_extendedprice), 4) AS l_extendedprice, round(median(l_quantity), 4) AS l_quantity,
  round(median(l_tax), 4) AS l_tax FROM lineitem GROUP BY 1""",
    "binary_encode": "WITH " + _SPLIT + "," + _codes("month") + "," + _codes("date") + f"""
SELECT x.series, CAST(x.dt AS VARCHAR) AS dt, {_bits("month", 4)}, {_bits("date", 5)}
FROM split x LEFT JOIN code_month c_month ON c_month.series = x.series AND c_month.c = x.month
LEFT JOIN code_date c_date ON c_date.series = x.series AND c_date.c = x."date\"""",
    "ordered_batches": "WITH " + _DAILY + """
SELECT series, CAST(dt AS VARCHAR) AS dt, CAST((row_number() OVER (PARTITION BY series ORDER BY dt) - 1) // 32 AS BIGINT) AS batch_id FROM bars""",
    "batch_mean_metrics": "WITH " + _DAILY_GOLD + _CANDIDATES.format(source="gold") + """,
b AS (SELECT *, (row_number() OVER (PARTITION BY series ORDER BY dt) - 1) // 32 AS batch FROM scored),
per AS (SELECT series, batch, avg(pow(pred_mean - close, 2)) AS mse, exp(avg(abs(pred_mean - close))) AS mae_ratio FROM b GROUP BY 1, 2)
SELECT series, round(avg(mse), 6) AS mse, round(avg(mae_ratio), 6) AS mae_ratio FROM per GROUP BY 1""",
    "event_index": """
SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS row_idx FROM events""",
    "running_volume": "WITH " + _MINUTES + f"""
SELECT series, {_clock("ts")}, volume, CAST(sum(volume) OVER (PARTITION BY series ORDER BY minutes.ts) AS BIGINT) AS running FROM minutes""",
    "walk_forward_folds": "WITH " + _FOLDS + " SELECT series, CAST(dt AS VARCHAR) AS dt, row_idx, fold, role FROM folded",
    "fold_regression": "WITH " + _FOLDS + " SELECT series, fold, round(slope, 4) AS slope, round(intercept, 4) AS intercept FROM fits",
    "fold_scores": "WITH " + _FOLDS + """,
e AS (
  SELECT v.series, v.fold, t.intercept + t.slope * CAST(v.open AS DOUBLE) / 100000.0 - v.close AS d
  FROM folded v JOIN fits t ON t.series = v.series AND t.fold = v.fold WHERE v.role = 'validation'),
per AS (SELECT series, fold, avg(d * d) AS mse, exp(avg(abs(d))) AS mae_ratio FROM e GROUP BY 1, 2)
SELECT series, CAST(0 AS BIGINT) AS config_id, round(avg(mse), 4) AS mse, round(avg(mae_ratio), 4) AS mae_ratio FROM per GROUP BY 1""",
    # One feature and a free intercept: ridge on centred values.
    "ridge_scores": "WITH " + _FOLDS + """,
moments AS (
  SELECT series, fold, count(*) AS n, avg(x) AS mx, avg(close) AS my, var_pop(x) * count(*) AS sxx, covar_pop(close, x) * count(*) AS sxy
  FROM (SELECT series, fold, role, close, CAST(open AS DOUBLE) / 100000.0 AS x FROM folded) WHERE role = 'train' GROUP BY 1, 2),
configs AS (SELECT CAST(unnest([0, 1, 2, 3, 4]) AS BIGINT) AS config_id, CAST(unnest([0.0, 0.1, 1.0, 10.0, 100.0]) AS DOUBLE) AS l2),
lines AS (SELECT m.series, m.fold, c.config_id, sxy / (sxx + l2) AS slope, my - sxy / (sxx + l2) * mx AS intercept FROM moments m, configs c),
per AS (
  SELECT v.series, v.fold, config_id, avg(pow(intercept + slope * CAST(v.open AS DOUBLE) / 100000.0 - v.close, 2)) AS mse
  FROM folded v JOIN lines l ON l.series = v.series AND l.fold = v.fold WHERE v.role = 'validation' GROUP BY 1, 2, 3)
SELECT config_id, round(avg(mse), 4) AS mse FROM per GROUP BY 1""",
    "hyperband_survivors": "WITH RECURSIVE " + _FOLDS + "," + _descent(27, 49, "1, 3, 9, 27") + "," + _halving(4) + "\n" + " UNION ALL ".join(
        ["SELECT * FROM (" + f"SELECT bracket, CAST({i} AS INTEGER) AS round, CAST(budget AS INTEGER) AS budget, config_id, round(mse, 6) AS mse, round(mae_ratio, 6) AS mae_ratio FROM r{i})"
         for i in range(4)]
    ),
    "step_losses": "WITH RECURSIVE " + _FOLDS + "," + _descent(8, 3, "1") + """
SELECT 'search/' || config_id AS run_id, CAST(epoch AS BIGINT) AS step, round(avg(loss), 6) AS mse FROM walk WHERE epoch > 0 GROUP BY ALL""",
    "tree_scores": "WITH " + _FOLDS + "," + _stumps(3) + """
SELECT CAST(0 AS BIGINT) AS config_id, round(avg(mse), 6) AS mse, round(avg(mae_ratio), 6) AS mae_ratio FROM per""",
    "run_table_best": "WITH " + _DAILY_GOLD + _CANDIDATES.format(source="gold") + """,
tall AS (
  SELECT 'weekly/mean' AS run_id, pred_mean AS p, close FROM scored
  UNION ALL SELECT 'weekly/open', pred_open, close FROM scored
  UNION ALL SELECT 'weekly/mid', pred_mid, close FROM scored),
per AS (SELECT run_id, avg(pow(p - close, 2)) AS mse FROM tall GROUP BY 1)
SELECT 'weekly' AS parent, run_id, round(mse, 6) AS mse FROM per ORDER BY per.mse, run_id LIMIT 1""",
    "early_stop": """
WITH RECURSIVE monthly AS (
  SELECT o_orderpriority AS series, date_trunc('month', o_orderdate) AS mon, round(avg(o_totalprice), 2) AS loss FROM orders GROUP BY 1, 2),
h AS (SELECT series, loss, row_number() OVER (PARTITION BY series ORDER BY mon) AS k FROM monthly),
walk AS (
  SELECT series, CAST('infinity' AS DOUBLE) AS best, 0 AS misses, CAST(0 AS BIGINT) AS epoch FROM (SELECT DISTINCT series FROM h)
  UNION ALL
  SELECT w.series, CASE WHEN h.loss + 10 < w.best THEN h.loss ELSE w.best END,
    CASE WHEN h.loss + 10 < w.best THEN 0 ELSE w.misses + 1 END, w.epoch + 1
  FROM walk w JOIN h ON h.series = w.series AND h.k = w.epoch + 1 WHERE w.misses < 5)
SELECT series, round(arg_max(best, epoch), 6) AS best, max(epoch) AS epoch FROM walk GROUP BY 1""",
    "best_candidate": "WITH " + _SPLIT + _CANDIDATES.format(source="split") + """,
recent AS (SELECT * FROM scored WHERE age > 100 AND age <= 107),
tall AS (
  SELECT series, 'mean' AS candidate, pred_mean AS p, close FROM recent
  UNION ALL SELECT series, 'open', pred_open, close FROM recent
  UNION ALL SELECT series, 'mid', pred_mid, close FROM recent),
per AS (SELECT series, candidate, avg(pow(p - close, 2)) AS mse, exp(avg(abs(p - close))) AS mae_ratio FROM tall GROUP BY 1, 2)
SELECT series, candidate, round(mse, 6) AS mse, round(mae_ratio, 6) AS mae_ratio FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY mse, candidate) AS k FROM per) WHERE k = 1""",
    # Least squares in three predictors by Cramer's rule on the covariances.
    "stacked_forecast": "WITH " + _SPLIT + _CANDIDATES.format(source="split") + """,
c AS (
  SELECT avg(close) AS my, avg(pred_mean) AS m1, avg(pred_open) AS m2, avg(pred_mid) AS m3,
    var_pop(pred_mean) AS a, covar_pop(pred_mean, pred_open) AS b, covar_pop(pred_mean, pred_mid) AS d,
    var_pop(pred_open) AS e, covar_pop(pred_open, pred_mid) AS f, var_pop(pred_mid) AS g,
    covar_pop(pred_mean, close) AS y1, covar_pop(pred_open, close) AS y2, covar_pop(pred_mid, close) AS y3
  FROM scored WHERE split = 'train'),
det AS (SELECT *, a * (e * g - f * f) - b * (b * g - f * d) + d * (b * f - e * d) AS det FROM c),
w AS (
  SELECT my, m1, m2, m3,
    (y1 * (e * g - f * f) - b * (y2 * g - f * y3) + d * (y2 * f - e * y3)) / det AS w1,
    (a * (y2 * g - f * y3) - y1 * (b * g - f * d) + d * (b * y3 - y2 * d)) / det AS w2,
    (a * (e * y3 - y2 * f) - b * (b * y3 - y2 * d) + y1 * (b * f - e * d)) / det AS w3 FROM det),
p AS (
  SELECT series, close, my + w1 * (pred_mean - m1) + w2 * (pred_open - m2) + w3 * (pred_mid - m3) AS pred
  FROM scored, w WHERE split = 'validation')
SELECT series, round(exp(avg(pred)) - 1, 2) AS forecast, round(avg(pow(pred - close, 2)), 4) AS mse,
  round(exp(avg(abs(pred - close))), 4) AS mae_ratio FROM p GROUP BY 1""",
    "score_forecast": "WITH " + _DAILY_GOLD + _CANDIDATES.format(source="gold") + """
SELECT series, round(exp(avg(pred_mean)) - 1, 4) AS forecast, round(avg(pow(pred_mean - close, 2)), 4) AS mse,
  round(exp(avg(abs(pred_mean - close))), 4) AS mae_ratio FROM scored GROUP BY 1""",
    "forecast_means": "WITH " + _DAILY_GOLD + _CANDIDATES.format(source="gold") + """
SELECT series, round(exp(avg(pred_mean)) - 1, 3) AS point, round(exp(avg(pred_mean)), 3) AS point_exp,
  round(avg(exp(pred_mean) - 1), 3) AS online, round(avg(exp(pred_mean)), 3) AS online_exp FROM scored GROUP BY 1""",
    "discrepancy": "WITH " + _SPLIT + _CANDIDATES.format(source="split") + """
SELECT series, CAST(dt AS VARCHAR) AS dt, round(ln(exp(close) - 1), 6) AS actual, round(ln(exp(pred_mid) - 1), 6) AS forecast,
  CASE WHEN pred_mid >= close THEN 'over' ELSE 'under' END AS side FROM scored WHERE split = 'test'""",
    "reference_window": "WITH " + _MINUTES + f""",
bounds AS (SELECT series, max(ts) - INTERVAL 3 DAYS AS since FROM minutes GROUP BY 1),
w AS (SELECT m.series, m.open, m.high, m.low, m.close, m.volume, m.ts AS dt FROM minutes m JOIN bounds b ON b.series = m.series WHERE m.ts >= b.since)
SELECT {_minute_columns("dt")} FROM w""",
    "reference_dead_series": "WITH " + _MINUTES + f""",
alive AS (SELECT * FROM minutes WHERE series <> 'error' OR ts < TIMESTAMP '2024-01-10'),
bounds AS (SELECT series, max(ts) - INTERVAL 3 DAYS AS since FROM alive GROUP BY 1),
w AS (SELECT m.* FROM alive m JOIN bounds b ON b.series = m.series WHERE m.ts >= b.since)
SELECT {_minute_columns()} FROM w""",
    "latest_stamp": "SELECT DISTINCT event_type AS series, 1 AS stamped FROM events",
    "latest_bar": "WITH " + _MINUTES + f""",
top AS (SELECT series, ts AS dt, open, high, low, close, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY ts DESC) AS k FROM minutes) WHERE k = 1)
SELECT {_minute_columns("dt")} FROM top""",
    "replay_sample": """
WITH ranked AS (SELECT event_type AS series, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS age FROM events),
buffer AS (SELECT * FROM ranked WHERE age <= 300),
drawn AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY age > 1,
  md5(event_id || ':11'), event_id) AS draw, count(*) OVER (PARTITION BY series) AS held FROM buffer)
SELECT series, event_id, round(value, 6) AS value FROM drawn WHERE draw <= 4 AND held >= 4""",
    "replay_order": """
WITH ranked AS (SELECT event_type AS series, event_id, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS age FROM events),
drawn AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY age > 1, md5(event_id || ':3'), event_id) AS draw FROM ranked WHERE age <= 300)
SELECT series, event_id, row_number() OVER (PARTITION BY series ORDER BY ts, event_id) - 1 AS place FROM drawn WHERE draw <= 25""",
    "replay_seeds": """
WITH ranked AS (SELECT event_type AS series, event_id, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS age FROM events),
drawn AS (SELECT CAST(seed AS INTEGER) AS seed, series, event_id, row_number() OVER (PARTITION BY seed, series ORDER BY age > 1, md5(event_id || ':' || seed), event_id) AS draw
  FROM ranked, range(5) AS s(seed) WHERE age <= 300)
SELECT seed, series, event_id FROM drawn WHERE draw <= 4""",
    "stream_bars": "WITH " + _MINUTES + f" SELECT {_minute_columns()} FROM minutes",
    "stream_latest": f"""
WITH top AS (SELECT event_type AS series, ts AS dt, value AS open, value AS high, value AS low, value AS close, CAST(1 AS BIGINT) AS volume
  FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) AS k FROM events) WHERE k = 1)
SELECT {_minute_columns("dt")} FROM top""",
    "stream_distinct": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "stream_gold": "WITH " + _INTRADAY + "," + _gold("intraday", "dt, timestamp_in_ms") + f" SELECT {_gold_columns(4)} FROM gold",
    "stream_decode": "WITH " + _RECORDS + f" SELECT {_bar_columns(4)} FROM sent WHERE h NOT IN (3, 4)",
    "stream_quarantine": "WITH " + _RECORDS + """
SELECT 'bad record' AS reason, count(*) AS n FROM sent WHERE h = 4 HAVING count(*) > 0
UNION ALL SELECT 'bad message', n FROM (
  SELECT count(*) AS n FROM (SELECT DISTINCT series, timestamp_in_ms // 3600000 FROM sent WHERE h = 3)) WHERE n > 0""",
    **dict.fromkeys(("stream_replay", "stream_replay_slots"), f"""
SELECT series, event_id, round(value, 6) AS value FROM (
  SELECT event_type AS series, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY {_PART} DESC, ts DESC, event_id DESC) AS age FROM events)
WHERE age <= 300"""),
    "online_step": """
WITH g AS (
  SELECT o_orderpriority AS series, count(*) AS n, avg(ln(1 + o_totalprice) * (o_totalprice / 100000.0)) * -2 AS gw,
    avg(ln(1 + o_totalprice)) * -2 AS gb, avg(pow(ln(1 + o_totalprice), 2)) AS mse FROM orders GROUP BY 1),
s AS (SELECT *, CASE WHEN sqrt(gw * gw + gb * gb) > 1 THEN 1 / sqrt(gw * gw + gb * gb) ELSE 1 END AS k FROM g)
SELECT series, round(-0.05 * gw * k, 6) AS w, round(-0.05 * gb * k, 6) AS b, CAST(1 AS BIGINT) AS steps, n AS "rows",
  round(mse, 6) AS mse, CAST(0 AS DOUBLE) AS forecast FROM s""",
    "stream_online": f"""
WITH m AS (
  SELECT event_type AS series, {_PART} AS batch_id, count(*) AS "rows", avg(x) AS x, avg(x * x) AS xx, avg(x * y) AS xy, avg(y) AS y, avg(y * y) AS yy
  FROM (SELECT *, user_id / 100.0 AS x, ln(1 + value) AS y FROM events) GROUP BY 1, 2),
s0 AS (SELECT *, 0.1 * xy AS w, 0.1 * y AS b, yy AS mse FROM m WHERE batch_id = 0),
s1 AS ({_online_step("s0", 1)}),
s2 AS ({_online_step("s1", 2)})
SELECT series, CAST(batch_id AS BIGINT) AS batch_id, round(w, 6) AS w, round(b, 6) AS b, "rows", round(mse, 6) AS mse
FROM (FROM s0 UNION ALL FROM s1 UNION ALL FROM s2)""",
    "stream_learn": _stream_learn(),
    "stream_drift": f"""
WITH recent AS (
  SELECT b, value, CAST(user_id AS DOUBLE) AS user_id, count(*) OVER (PARTITION BY b, event_type) AS held,
    row_number() OVER (PARTITION BY b, event_type ORDER BY part DESC, ts DESC, event_id DESC) AS age
  FROM (SELECT *, {_PART} AS part FROM events) e, range(3) AS t(b) WHERE part <= b),""" + _ks("""
SELECT b, 'value' AS "column", value AS v, 1 AS r FROM events, range(3) AS t(b) WHERE ts < TIMESTAMP '2024-01-21'
UNION ALL SELECT b, 'user_id', CAST(user_id AS DOUBLE), 1 FROM events, range(3) AS t(b) WHERE ts < TIMESTAMP '2024-01-21'
UNION ALL SELECT b, 'value', value, 0 FROM recent WHERE age <= 100 AND held >= 100
UNION ALL SELECT b, 'user_id', user_id, 0 FROM recent WHERE age <= 100 AND held >= 100""", 'b, "column"') + """
SELECT CAST(b AS BIGINT) AS batch_id, "column", n_ref, n_cur, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value,
  CASE WHEN p_value < 0.05 THEN 'drift' ELSE 'stable' END AS flag FROM tested WHERE n_cur > 0""",
}
