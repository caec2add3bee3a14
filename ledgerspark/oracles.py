"""The registered queries once more, as SQL for an independent engine.

Each text is written from the meaning of the query, not from its Spark plan:
ranks are taken over whole tables, fills over whole partitions, the distance
formula is iterated without any acceleration.
"""

from __future__ import annotations

TXN = """txn AS (
  SELECT event_id AS row_id, user_id AS cc_num, event_type AS category, value AS amt,
    CAST(ts AS TIMESTAMP) AS trans_date_trans_time,
    CAST(date '1940-01-01' + CAST((user_id * 263) % 22000 AS INT) AS DATE) AS dob,
    CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CASE WHEN event_id % 7 = 0 THEN NULL
         ELSE concat('job_', CAST(user_id % 11 AS VARCHAR)) END AS job,
    CASE WHEN event_id % 11 = 0 THEN NULL
         ELSE 100 + (user_id * 7919) % 1000000 END AS city_pop,
    25 + CAST((user_id * 37) % 2400 AS DOUBLE) / CAST(100 AS DOUBLE) AS lat,
    -120 + CAST((user_id * 53) % 5000 AS DOUBLE) / CAST(100 AS DOUBLE) AS "long",
    25 + CAST((user_id * 37) % 2400 AS DOUBLE) / CAST(100 AS DOUBLE)
      + CAST((event_id * 17) % 200 - 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS merch_lat,
    -120 + CAST((user_id * 53) % 5000 AS DOUBLE) / CAST(100 AS DOUBLE)
      + CAST((event_id * 29) % 200 - 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS merch_long,
    CASE WHEN event_type IN ('purchase', 'error') AND value > 150 THEN 1 ELSE 0 END AS is_fraud
  FROM events)"""

RECORDS = """records AS (
  SELECT row_id, strftime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S') AS trans_date_trans_time,
    category, amt, gender, concat('city_', CAST(cc_num % 97 AS VARCHAR)) AS city,
    concat('S', CAST(cc_num % 50 AS VARCHAR)) AS state, 10000 + cc_num % 90000 AS zip,
    lat, "long", coalesce(city_pop, 0) AS city_pop, coalesce(job, 'none') AS job,
    strftime(dob, '%Y-%m-%d') AS dob, merch_lat, merch_long, is_fraud
  FROM txn)"""

_TIME = """CAST(hour(trans_date_trans_time) AS BIGINT) AS hour,
  CAST(day(trans_date_trans_time) AS BIGINT) AS day,
  CAST(month(trans_date_trans_time) AS BIGINT) AS month,
  CAST(isodow(trans_date_trans_time) - 1 AS BIGINT) AS day_of_week,
  CAST(CASE WHEN isodow(trans_date_trans_time) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend"""

_AGE = """CAST(floor(floor((epoch_us(trans_date_trans_time)
  - epoch_us(CAST(dob AS TIMESTAMP))) / 86400000000.0) / 365.0) AS BIGINT) AS age"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join((TXN, *parts)) + "\n"


def _distance(source: str, rounds: int = 10) -> str:
    """CTEs that end in ``geo(row_id, km)``, by plain fixed-point rounds."""
    f = "(1.0::DOUBLE / 298.257223563::DOUBLE)"
    b = f"(6378.137::DOUBLE * (1 - {f}))"
    e2 = f"(pow(6378.137::DOUBLE / {b}, 2) - 1)"
    dl = '(CAST(merch_long AS DOUBLE) - CAST("long" AS DOUBLE))'
    steps = [f"""g_in AS (
  SELECT row_id, (1 - {f}) * tan(radians(lat)) AS t1, (1 - {f}) * tan(radians(merch_lat)) AS t2,
    radians({dl} - 360 * floor(({dl} + 180) / 360)) AS dl
  FROM {source})""", """g0 AS (
  SELECT row_id, dl, dl AS la, t1 / sqrt(1 + t1 * t1) AS s1, t2 / sqrt(1 + t2 * t2) AS s2,
    1 / sqrt(1 + t1 * t1) AS c1, 1 / sqrt(1 + t2 * t2) AS c2 FROM g_in)"""]
    for i in range(rounds):
        steps.append(f"""a{i} AS (SELECT *,
  sqrt(pow(c2 * sin(la), 2) + pow(c1 * s2 - s1 * c2 * cos(la), 2)) AS ss,
  s1 * s2 + c1 * c2 * cos(la) AS cs FROM g{i})""")
        steps.append(f"""b{i} AS (SELECT *, atan2(ss, cs) AS arc,
  CASE WHEN ss = 0 THEN 0 ELSE c1 * c2 * sin(la) / ss END AS sa FROM a{i})""")
        steps.append(f"""c{i} AS (SELECT *,
  CASE WHEN 1 - sa * sa < 1e-15 THEN 0 ELSE cs - 2 * s1 * s2 / (1 - sa * sa) END AS m,
  {f} / 16 * (1 - sa * sa) * (4 + {f} * (4 - 3 * (1 - sa * sa))) AS c FROM b{i})""")
        steps.append(f"""g{i + 1} AS (SELECT row_id, dl, s1, s2, c1, c2,
  ss AS ss_, cs AS cs_, arc AS arc_, sa AS sa_, m AS m_,
  dl + (1 - c) * {f} * sa * (arc + c * ss * (m + c * cs * (2 * m * m - 1))) AS la FROM c{i})""")
    steps.append(f"""u AS (SELECT *, (1 - sa_ * sa_) * {e2} AS u FROM g{rounds})""")
    steps.append("""v AS (SELECT *,
  1 + u / 16384 * (4096 + u * (-768 + u * (320 - 175 * u))) AS ka,
  u / 1024 * (256 + u * (-128 + u * (74 - 47 * u))) AS kb FROM u)""")
    steps.append(f"""geo AS (SELECT row_id, {b} * ka * (arc_ - kb * ss_ * (m_ + kb / 4 * (
  cs_ * (2 * m_ * m_ - 1) - kb / 6 * m_ * (4 * ss_ * ss_ - 3) * (4 * m_ * m_ - 3)))) AS km
  FROM v)""")
    return ",\n".join(steps)


def _numbers(source: str, col: str, label: str | None = None, text: bool = False) -> str:
    extra = "CAST(NULL AS BIGINT) AS n_unique, CAST(NULL AS VARCHAR) AS top, " \
            "CAST(NULL AS BIGINT) AS freq, " if text else ""
    quart = ", ".join(
        f"round(quantile_cont(CAST({col} AS DOUBLE), {p}), 4) AS p{int(p * 100)}"
        for p in (0.25, 0.5, 0.75))
    return f"""SELECT '{label or col}' AS "column", count({col}) AS n, {extra}
  round(avg({col}), 4) AS mean, round(stddev_samp({col}), 4) AS std,
  round(CAST(min({col}) AS DOUBLE), 4) AS min, {quart},
  round(CAST(max({col}) AS DOUBLE), 4) AS max FROM {source}"""


def _text(source: str, col: str, numbers: bool = False) -> str:
    extra = "".join(f", CAST(NULL AS DOUBLE) AS {c}" for c in
                    ("mean", "std", "min", "p25", "p50", "p75", "max")) if numbers else ""
    return f"""SELECT '{col}' AS "column", (SELECT count({col}) FROM {source}) AS n,
  (SELECT count(DISTINCT {col}) FROM {source}) AS n_unique, v AS top, k AS freq{extra}
  FROM (SELECT {col} AS v, count(*) AS k FROM {source} WHERE {col} IS NOT NULL
        GROUP BY {col} ORDER BY k DESC, v LIMIT 1)"""


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)


def _marked(cols: list[str]) -> str:
    """Columns as one text in which lengths and gaps are marked."""
    return " || ".join(
        f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in cols)


def _fingerprint(source: str, cols: list[str]) -> str:
    words = ", ".join(f"CAST('0x' || substr(d, {1 + 13 * i}, 13) AS BIGINT) AS w{i}" for i in range(5))
    parts = ", ".join(f"CAST(sum(w{i}) AS VARCHAR), CAST(bit_xor(w{i}) AS VARCHAR)" for i in range(5))
    return f"""d AS (SELECT sha256({_marked(cols)}) AS d FROM {source}),
h AS (SELECT {words} FROM d)
SELECT count(*) AS n_rows, sha256(concat_ws('|', '{len(cols)}', CAST(count(*) AS VARCHAR),
  {parts})) AS fingerprint FROM h"""


def _fingerprint_of_parts(source: str, cols: list[str]) -> str:
    words = ", ".join(f"CAST('0x' || substr(d, {1 + 11 * i}, 11) AS BIGINT) AS w{i}" for i in range(4))
    parts = ", ".join(f"CAST(sum(w{i} & 4194303) AS VARCHAR), CAST(sum(w{i} >> 22) AS VARCHAR)" for i in range(4))
    return f"""d AS (SELECT sha256({_marked(cols)}) AS d FROM {source}),
h AS (SELECT {words} FROM d)
SELECT count(*) AS n_rows, sha256(concat_ws('|', '{len(cols)}', CAST(count(*) AS VARCHAR),
  {parts})) AS fingerprint FROM h"""


def _report(source: str, checks: list[tuple]) -> str:
    """checks: (rule, column, check, SQL condition or None if absent, fatal)."""
    rows = []
    for seq, (rule, column, check, condition, fatal) in enumerate(checks):
        n = "1" if condition is None else \
            f"(SELECT count(*) FROM {source} WHERE {condition})"
        rows.append(f"""SELECT CAST({seq} AS BIGINT) AS check_order,
  CAST({rule} AS BIGINT) AS rule_order, '{column}' AS "column", '{check}' AS "check",
  CAST({n} AS BIGINT) AS violations, '{'error' if fatal else 'warning'}' AS bad""")
    return "report AS (" + " UNION ALL ".join(rows) + """)
SELECT check_order, rule_order, "column", "check", violations,
  CASE WHEN violations > 0 THEN bad ELSE 'ok' END AS status FROM report"""


_CHECKS = [
    (0, "cc_num", "missing", "cc_num IS NULL", True),
    (0, "cc_num", "type", "false", True),
    (0, "cc_num", "minimum", "cc_num < 5", True),
    (1, "category", "missing", "category IS NULL", True),
    (1, "category", "type", "false", True),
    (1, "category", "allowed",
     "category IS NULL OR category NOT IN ('view', 'click', 'purchase', 'signup')", True),
    (2, "amt", "missing", "amt IS NULL", True),
    (2, "amt", "type", "false", True),
    (2, "amt", "minimum", "amt < 1", True),
    (3, "job", "missing", "job IS NULL", True),
    (3, "job", "type", "false", True),
    (3, "job", "allowed",
     "job IS NULL OR job NOT IN ('job_0', 'job_1', 'job_2', 'job_3')", True),
    (4, "city_pop", "missing", "city_pop IS NULL", False),
    (4, "city_pop", "type", "false", True),
    (4, "city_pop", "minimum", "city_pop < 5000", True),
    (5, "gender", "missing", "gender IS NULL", False),
    (5, "gender", "type", "gender IS NOT NULL", True),
    (6, "nickname", "present", None, False),
    (7, "street", "present", None, True),
]

_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
_JOBS = sorted(f"job_{i}" for i in range(11))


def _fill(parts: str, order: str, cols=("job", "city_pop"), how: str = "both") -> str:
    by = f"PARTITION BY {parts} " if parts else ""
    out = []
    for c in cols:
        before = f"last_value({c} IGNORE NULLS) OVER ({by}ORDER BY {order} " \
                 "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        after = f"first_value({c} IGNORE NULLS) OVER ({by}ORDER BY {order} " \
                "ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
        value = {"forward": before, "backward": after,
                 "both": f"coalesce({before}, {after})"}[how]
        out.append(f"{value} AS {c}")
    return ", ".join(out)


def _dictionary(*cols: str) -> str:
    """Codes of two thirds of the rows, given to the other third."""
    codes = [f"""c_{c} AS (SELECT {c}, row_number() OVER (ORDER BY {c}) - 1 AS code
  FROM (SELECT DISTINCT {c} FROM txn WHERE row_id % 3 <> 0 AND {c} IS NOT NULL))""" for c in cols]
    made = ", ".join(f"CASE WHEN t.{c} IS NOT NULL THEN coalesce(c_{c}.code, -1) END AS {c}" for c in cols)
    joins = " ".join(f"LEFT JOIN c_{c} ON c_{c}.{c} = t.{c}" for c in cols)
    return _with(*codes) + f"SELECT t.row_id, {made} FROM txn t {joins} WHERE t.row_id % 3 = 0"


def _scaled(col: str, source: str) -> str:
    """Standard-scaled with gaps at the mean, from the statistics of ``source``."""
    mean = f"(SELECT avg({col}) FROM {source})"
    sd = f"(SELECT stddev_pop(coalesce({col}, {mean})) FROM {source})"
    return f"round((coalesce({col}, {mean}) - {mean}) / {sd}, 4)"


def _mode(col: str, source: str) -> str:
    return f"(SELECT {col} FROM {source} WHERE {col} IS NOT NULL GROUP BY {col} " \
           f"ORDER BY count(*) DESC, {col} LIMIT 1)"


def _split(source: str, label: str, key: str, seed: int, test: float, valid: float) -> str:
    """CTEs that end in ``parts`` (every column of the source, and split).

    Quotas are floors plus largest remainders; ties go to the smaller label.
    """
    def quota(name: str, base: str, size: str) -> str:
        return f"""{name} AS (
  SELECT label, n, fl + CASE WHEN row_number() OVER (ORDER BY rest DESC, label)
      <= size - sum(fl) OVER () THEN 1 ELSE 0 END AS q
  FROM (SELECT label, n, size, n * size // total AS fl, n * size % total AS rest
        FROM (SELECT label, n, CAST({size} AS BIGINT) AS size, total
              FROM (SELECT label, n, CAST(sum(n) OVER () AS BIGINT) AS total FROM {base}))))"""

    d = f"CAST({test} AS DOUBLE)"
    v = f"CAST({valid} AS DOUBLE)"
    steps = [f"classes AS (SELECT {label} AS label, count(*) AS n FROM {source} GROUP BY {label})",
             quota("held", "classes", f"ceil(({d} + {v}) * total)")]
    if valid:
        steps.append("held_n AS (SELECT label, q AS n FROM held)")
        steps.append(quota("tested", "held_n", f"ceil({d} / ({d} + {v}) * total)"))
    else:
        steps.append("tested AS (SELECT * FROM held)")
    steps.append(f"""parts AS (
  SELECT s.* EXCLUDE (place), CASE WHEN place <= tested.q THEN 'test'
    WHEN place <= held.q THEN 'valid' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY {label}
          ORDER BY md5('{seed}' || '|' || {key})) AS place FROM {source}) s
  JOIN held ON held.label = s.{label} JOIN tested ON tested.label = s.{label})""")
    return ",\n".join(steps)


_GUESS = "guess AS (SELECT *, CASE WHEN amt > 100 THEN 1 ELSE 0 END AS prediction FROM txn)"


def _metrics(source: str, by: str | None = None, counts: bool = False) -> str:
    group = f"GROUP BY {by}" if by else ""
    first = f"{by} AS {by}, " if by else ""
    shown = "n, tn, fp, fn, tp" if counts else "n"
    return f"""cm AS (SELECT {first}count(*) AS n,
  count(*) FILTER (is_fraud = 0 AND prediction = 0) AS tn,
  count(*) FILTER (is_fraud = 0 AND prediction = 1) AS fp,
  count(*) FILTER (is_fraud = 1 AND prediction = 0) AS fn,
  count(*) FILTER (is_fraud = 1 AND prediction = 1) AS tp FROM {source} {group}),
pr AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0::DOUBLE END AS p,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0::DOUBLE END AS r FROM cm)
SELECT {f'{by}, ' if by else ''}{shown}, round((tp + tn) / n, 4) AS accuracy,
  round(p, 4) AS precision, round(r, 4) AS recall,
  round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0::DOUBLE END, 4) AS f1_score,
  CASE WHEN tp + fn = 0 OR tn + fp = 0 THEN NULL
       ELSE round((r + tn / (tn + fp)) / 2, 4) END AS auc_roc FROM pr"""


_LINE_ID = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_LINE_KEY = _marked(_LINE_ID)
_ROW_KEY = _marked(["row_id"])
_FIELDS = ('trans_date_trans_time, category, amt, gender, city, state, zip, lat, "long", '
           "city_pop, job, dob, merch_lat, merch_long")
_SCHEMA = [
    ("row_id", "int"), ("cc_num", "int"), ("category", "str"), ("amt", "float"),
    ("trans_date_trans_time", "timestamp"), ("dob", "date"), ("gender", "str"),
    ("job", "str"), ("city_pop", "int"), ("lat", "float"), ("long", "float"),
    ("merch_lat", "float"), ("merch_long", "float"), ("is_fraud", "int"),
]


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}

    # features
    o["feat_time"] = _with() + f"SELECT row_id, {_TIME} FROM txn"
    o["feat_age"] = _with() + f"SELECT row_id, {_AGE} FROM txn"
    o["feat_geo_distance"] = _with(_distance("txn")) + \
        "SELECT row_id, round(km, 4) AS geo_distance FROM geo"
    usable = "row_id % 5 <> 0 AND row_id % 7 <> 0 AND row_id % 11 <> 0 AND row_id % 13 <> 0"
    o["feat_geo_bad_input"] = _with(_distance("txn")) + f"""SELECT row_id,
  CASE WHEN {usable} THEN round(km, 4) ELSE 0.0::DOUBLE END AS geo_distance FROM geo"""
    o["feat_all"] = _with(_distance("txn")) + f"""SELECT txn.row_id, amt, {_TIME}, {_AGE},
  round(km, 4) AS geo_distance FROM txn JOIN geo ON geo.row_id = txn.row_id"""
    o["feat_splits"] = o["feat_all"]
    # Records carry whole seconds, which no feature but the time itself reads.
    o["featurize_table"] = o["feat_all"]
    o["parse_layouts"] = _with() + """SELECT row_id, CASE row_id % 4
  WHEN 0 THEN strftime(trans_date_trans_time, '%Y-%m-%d %H:%M:%S')
  WHEN 1 THEN strftime(trans_date_trans_time, '%Y-%m-%d %H:%M:00')
  WHEN 2 THEN strftime(trans_date_trans_time, '%Y-%m-%d 00:00:00') END AS at FROM txn"""

    # profile
    names = ",".join(n for n, _ in _SCHEMA)
    o["profile_shape"] = _with() + f"""SELECT count(*) AS n_rows,
  CAST({len(_SCHEMA)} AS BIGINT) AS n_cols, '{names}' AS columns,
  count(*) = 0 AS is_empty FROM txn"""
    o["profile_duplicates"] = _with() + """SELECT count(*) AS n_rows, count(*) - (SELECT count(*)
  FROM (SELECT DISTINCT cc_num, category, gender, job, dob FROM txn)) AS n_duplicates FROM txn"""
    o["profile_describe_numeric"] = _with() + _union(
        [_numbers("txn", c) for c in
         ("cc_num", "amt", "city_pop", "lat", "merch_long", "is_fraud")])
    o["profile_describe_string"] = _with() + _union(
        [_text("txn", c) for c in ("category", "gender", "job")])
    o["profile_describe_all"] = _with() + _union([
        _numbers("txn", "amt", text=True), _text("txn", "category", True),
        _numbers("txn", "city_pop", text=True), _text("txn", "job", True)])
    def seconds(col: str) -> str:
        return f"(epoch_us(CAST({col} AS TIMESTAMP)) / 1000000.0::DOUBLE)"

    typed = "typed AS (SELECT *, isodow(dob) >= 6 AS weekend FROM txn)"
    day = "CAST(weekend AS VARCHAR)"
    o["profile_describe_typed"] = _with(typed) + _union(
        [_numbers("typed", c, text=True) for c in ("row_id", "cc_num", "amt", "city_pop", "lat", "merch_lat", "merch_long", "is_fraud")]
        + [_numbers("typed", '"long"', "long", text=True)]
        + [_numbers("typed", seconds(c), c, text=True) for c in ("trans_date_trans_time", "dob")]
        + [_text("typed", c, True) for c in ("category", "gender", "job")]
        + [_text("typed", day, True).replace(f"'{day}'", "'weekend'")])
    o["profile_fingerprint"] = _with(_fingerprint("txn", [
        "row_id", "cc_num", "category", "gender", "job", "city_pop", "is_fraud"]))
    o["fingerprint_changes"] = _with("""c AS (
  SELECT row_id, job, concat('00', cc_num % 9) AS code FROM txn WHERE cc_num % 9 NOT IN (3, 4)
  UNION ALL SELECT row_id, job || '!', concat('00', cc_num % 9) FROM txn WHERE cc_num % 9 = 4)""",
        _fingerprint_of_parts("c", ["row_id", "job", "code"]))
    o["scoring_columns"] = _with() + _union([
        f"""SELECT CAST({i} AS BIGINT) AS position, '{n}' AS "column", {str(there).lower()} AS present,
  CAST({f'count(*) FILTER (WHERE "{n}" IS NULL)' if there else 'CASE WHEN count(*) < 0 THEN 0 END'} AS BIGINT) AS n_missing FROM txn"""
        for i, (n, there) in enumerate([("category", True), ("job", True), ("nickname", False), ("amt", True), ("street", False)])])
    mark = "CASE WHEN row_id % 5 = 0 THEN '<null>' ELSE job END"
    cuts = [("concat_ws('|', category, gender)", mark), ("category", f"concat_ws('|', gender, {mark})")]
    o["fingerprint_separators"] = _union([
        _with(f"c AS (SELECT {a} AS a, {b} AS b FROM txn)", _fingerprint("c", ["a", "b"])).replace(
            ")) AS fingerprint FROM h", f")) AS fingerprint, {i} AS cut FROM h")
        for i, (a, b) in enumerate(cuts)])
    o["schema_export"] = _with() + _union([
        f"""SELECT CAST({i} AS BIGINT) AS position, '{n}' AS "column", '{t}' AS dtype,
  count("{n}") AS n_values FROM txn""" for i, (n, t) in enumerate(_SCHEMA)])
    o["sample_head"] = _with() + \
        "SELECT row_id, cc_num, category, amt FROM txn ORDER BY amt, row_id LIMIT 100"

    # validate
    o["validate_report"] = _with(_report("txn", _CHECKS))
    first = _report("txn", _CHECKS)
    o["validate_first_failure"] = _with(first) + \
        " WHERE violations > 0 AND bad = 'error' ORDER BY check_order LIMIT 1"
    broken = ", ".join(
        f"CASE WHEN {cond} THEN '{col}:{check}' END"
        for _, col, check, cond, fatal in _CHECKS if fatal and cond not in ("false", None))
    o["validate_violations"] = _with() + f"""SELECT * FROM (
  SELECT row_id, concat_ws(',', {broken}) AS violations FROM txn) WHERE violations <> ''"""
    o["validate_allowed_nulls"] = _with(_report("txn", [
        (0, "job", "missing", "job IS NULL", False),
        (0, "job", "allowed", "job IS NULL", True)]))
    o["validate_min"] = _with(_report("txn", [
        (0, "city_pop", "missing", "city_pop IS NULL", False),
        (0, "city_pop", "type", "false", True),
        (0, "city_pop", "minimum", "city_pop < 500000", True)]))
    o["validate_text"] = _with(_report("txn", [
        (0, "cc_num", "missing", "row_id % 10 = 0 AND row_id % 6 <> 0", False),
        (0, "cc_num", "type", "row_id % 6 = 0", True),
        (0, "cc_num", "minimum", "cc_num < 5 AND row_id % 10 <> 0 AND row_id % 6 <> 0", True),
        (1, "amt", "missing", "false", True),
        (1, "amt", "type", "row_id % 9 = 0", True),
        (1, "amt", "minimum", "amt < 1 AND row_id % 9 <> 0", True),
        (2, "gender", "missing", "false", True),
        (2, "gender", "type", "false", True)]))

    o["validate_text_allowed"] = _with(_report("txn", [
        (0, "is_fraud", "missing", "row_id % 10 = 0", False),
        (0, "is_fraud", "type", "false", True),
        (0, "is_fraud", "allowed", "row_id % 10 = 0", True),
        (1, "share", "missing", "false", False),
        (1, "share", "type", "row_id % 4 > 1", True),
        (1, "share", "allowed", "row_id % 4 > 1", True),
        (2, "gender", "missing", "false", False),
        (2, "gender", "type", "false", True),
        (2, "gender", "allowed", "gender <> 'F'", True)]))

    # fill
    o["fill_ffill"] = _with() + \
        f"SELECT row_id, {_fill('', 'row_id', how='forward')} FROM txn"
    o["fill_bfill"] = _with() + \
        f"SELECT row_id, {_fill('', 'row_id', how='backward')} FROM txn"
    o["fill_missing"] = _with() + \
        f"SELECT row_id, {_fill('', 'trans_date_trans_time, row_id')} FROM txn"
    o["fill_missing_by_card"] = _with() + \
        f"SELECT row_id, cc_num, {_fill('cc_num', 'row_id')} FROM txn"
    hot = """hot AS (SELECT * REPLACE (CASE WHEN row_id % 3 = 0 THEN 0 ELSE cc_num END AS cc_num)
  FROM txn)"""
    o["fill_missing_hot_key"] = _with(hot) + \
        f"SELECT row_id, cc_num, {_fill('cc_num', 'row_id')} FROM hot"
    o["validate_and_fill"] = _with() + \
        f"SELECT row_id, cc_num, amt, {_fill('', 'row_id')} FROM txn"

    # prep
    code = "CASE WHEN {c} IS NULL THEN NULL ELSE dense_rank() OVER (ORDER BY {c}) - 1 END AS {c}"
    o["label_encode"] = _with() + "SELECT row_id, " + ", ".join(
        code.format(c=c) for c in ("category", "job", "gender")) + " FROM txn"
    o["label_encode_wide"] = _with() + "SELECT row_id, " + ", ".join(
        code.format(c=c) for c in ("cc_num", "amt", "city_pop")) + " FROM txn"
    o["label_dictionary"] = _dictionary("category", "job", "cc_num", "amt")
    o["label_dictionary_wide"] = _dictionary("cc_num", "city_pop")
    o["label_dictionary_stream"] = _dictionary("cc_num", "amt")
    held = "CASE WHEN {c} IN (SELECT {c} FROM txn WHERE row_id % 3 <> 0) THEN {c} END AS {c}"
    o["label_dictionary_decoded"] = _with() + "SELECT row_id, " + ", ".join(
        held.format(c=c) for c in ("job", "cc_num")) + " FROM txn WHERE row_id % 3 = 0"
    lines = """o AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  CASE WHEN l_linenumber <> 2 THEN concat('o', CAST(l_orderkey AS VARCHAR)) END AS "order" FROM lineitem)"""
    o["impute_mode_wide"] = f"""WITH {lines} SELECT * REPLACE (coalesce("order", {_mode('"order"', 'o')}) AS "order") FROM o"""
    filled = f"f AS (SELECT row_id, coalesce(job, {_mode('job', 'txn')}) AS job, CAST(cc_num AS VARCHAR) AS card FROM txn)"
    o["onehot_sparse"] = _with(filled) + """SELECT row_id, dense_rank() OVER (ORDER BY job) - 1 AS job_at,
  dense_rank() OVER (ORDER BY card) - 1 AS card_at FROM f"""
    o["impute_mean"] = _with() + """SELECT row_id,
  round(coalesce(city_pop, (SELECT avg(city_pop) FROM txn)), 4) AS city_pop FROM txn"""
    o["scale_standard"] = _with() + f"""SELECT row_id, {_scaled('amt', 'txn')} AS amt,
  {_scaled('city_pop', 'txn')} AS city_pop, 0.0::DOUBLE AS fixed FROM txn"""
    low = "(SELECT min({c}) FROM txn)"
    span = "((SELECT max({c}) FROM txn) - (SELECT min({c}) FROM txn))"
    mm = f"round((coalesce({{c}}, (SELECT avg({{c}}) FROM txn)) - {low}) / {span}, 4) AS {{c}}"
    o["scale_minmax"] = _with() + \
        f"SELECT row_id, {mm.format(c='amt')}, {mm.format(c='city_pop')} FROM txn"
    o["scale_per_column"] = _with() + f"""SELECT row_id, {mm.format(c='amt')},
  round(coalesce(city_pop, (SELECT avg(city_pop) FROM txn)), 4) AS city_pop, {_scaled('lat', 'txn')} AS lat FROM txn"""
    o["impute_mode"] = _with() + \
        f"SELECT row_id, coalesce(job, {_mode('job', 'txn')}) AS job FROM txn"

    def hots(col: str, values: list[str], value: str | None = None) -> str:
        return ", ".join(
            f"""CAST(CASE WHEN {value or col} = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS "{col}_{v}\""""
            for v in values)

    o["onehot"] = _with() + \
        f"SELECT row_id, {hots('gender', ['F', 'M'])}, {hots('category', _EVENT_TYPES)} FROM txn"
    o["prep_all"] = _with() + "SELECT row_id, " + ", ".join(
        f"{_scaled(c, 'txn')} AS {c}" for c in ("amt", "city_pop", "lat")) + \
        f", {hots('job', _JOBS, 'coalesce(job, ' + _mode('job', 'txn') + ')')}, " \
        f"{hots('gender', ['F', 'M'])} FROM txn"
    fit = "fit AS (SELECT * FROM txn WHERE row_id % 3 = 0 AND category <> 'error')"
    o["prep_train_apply"] = _with(fit) + "SELECT row_id, " + ", ".join(
        f"{_scaled(c, 'fit')} AS {c}" for c in ("amt", "city_pop")) + \
        f", {hots('category', [e for e in _EVENT_TYPES if e != 'error'])} " \
        "FROM txn WHERE row_id % 3 = 1"
    coded = """coded AS (SELECT row_id, is_fraud, amt, city_pop,
  CAST(hour(trans_date_trans_time) AS BIGINT) AS hour,
  dense_rank() OVER (ORDER BY category) - 1 AS category FROM txn)"""
    o["preprocess_table"] = _with(coded) + "SELECT row_id, is_fraud, " + ", ".join(
        f"{_scaled(c, 'coded')} AS {c}" for c in ("amt", "city_pop", "hour", "category")) + \
        " FROM coded"

    # columns
    o["select_engineered"] = _with() + f"""SELECT * EXCLUDE (is_weekend) FROM (
  SELECT amt, city_pop, {_TIME}, category, gender FROM txn)"""
    o["select_raw"] = _with(RECORDS) + f"SELECT {_FIELDS} FROM records"
    o["rename_columns"] = _with() + \
        "SELECT row_id, trans_date_trans_time AS happened, dob, amt AS amount FROM txn"
    o["attach_target"] = _with() + "SELECT row_id, amt, is_fraud FROM txn"
    o["response_columns"] = _with() + \
        "SELECT is_fraud AS prediction, CAST(is_fraud AS DOUBLE) / 2 AS probability FROM txn"

    # split
    o["split_two_way"] = _with(_split("txn", "is_fraud", _ROW_KEY, 42, 0.2, 0.0)) + \
        "SELECT row_id, is_fraud, split FROM parts"
    o["split_three_way"] = _with(_split("txn", "is_fraud", _ROW_KEY, 7, 0.2, 0.1)) + \
        "SELECT row_id, is_fraud, split FROM parts"
    o["split_many_classes"] = _with(_split("txn", "category", _ROW_KEY, 42, 0.15, 0.25)) + \
        "SELECT row_id, category, split FROM parts"
    labelled = "labelled AS (SELECT *, is_fraud = 1 AS fraud, row_id % 3 * 1e7::DOUBLE + 0.1::DOUBLE AS label_ FROM txn)"
    o["split_boolean_label"] = _with(labelled, _split("labelled", "fraud", _ROW_KEY, 42, 0.2, 0.1)) + \
        "SELECT row_id, fraud, split FROM parts"
    o["split_double_label"] = _with(labelled, _split("labelled", "label_", _ROW_KEY, 42, 0.2, 0.1)) + \
        "SELECT row_id, split FROM parts"
    twice = f"twice AS (SELECT {', '.join(_LINE_ID)}, copy FROM lineitem, (VALUES (0), (1)) AS v(copy))"
    o["split_wide_classes"] = f"WITH {twice},\n" + _split(
        "twice", "l_orderkey", _marked([*_LINE_ID, "copy"]), 42, 0.3, 0.0) + \
        f"\nSELECT {', '.join(_LINE_ID)}, copy, split FROM parts"
    o["class_weights"] = _with() + """SELECT is_fraud AS label, count(*) AS n_rows,
  round((SELECT count(*) FROM txn) / ((SELECT count(DISTINCT is_fraud) FROM txn) * count(*)), 4)
  AS weight FROM txn GROUP BY is_fraud"""

    # evaluate
    o["eval_confusion"] = _with(_GUESS) + """SELECT count(*) AS n,
  count(*) FILTER (is_fraud = 0 AND prediction = 0) AS tn,
  count(*) FILTER (is_fraud = 0 AND prediction = 1) AS fp,
  count(*) FILTER (is_fraud = 1 AND prediction = 0) AS fn,
  count(*) FILTER (is_fraud = 1 AND prediction = 1) AS tp FROM guess"""
    o["eval_not_a_class"] = _with() + \
        "SELECT count(*) AS n, count(*) FILTER (row_id % 9 = 0) AS not_a_class FROM txn"
    o["eval_metrics"] = _with(_GUESS, _metrics("guess", counts=True))
    o["eval_by_split"] = _with(
        _GUESS, _split("guess", "is_fraud", _ROW_KEY, 42, 0.2, 0.2), _metrics("parts", "split"))
    o["eval_by_category"] = _with(_GUESS, _metrics("guess", "category"))
    o["eval_listed_metrics"] = f"""SELECT category, n, f1_score, recall, auc_roc
FROM ({_with(_GUESS, _metrics("guess", "category"))})"""
    o["eval_auc_probability"] = _with(
        "p AS (SELECT round(amt / 600, 3) AS p, is_fraud FROM txn)",
        """ranked AS (SELECT is_fraud, rank() OVER (ORDER BY p)
  + (count(*) OVER (PARTITION BY p) - 1) / 2.0 AS place FROM p)""") + \
        """SELECT round((sum(CASE WHEN is_fraud = 1 THEN place END)
    - sum(is_fraud) * (sum(is_fraud) + 1) / 2.0)
  / (sum(is_fraud) * CAST(sum(1 - is_fraud) AS DOUBLE)), 6) AS auc_roc_proba FROM ranked"""

    # sources and sinks
    plain = _FIELDS.replace(" job,", "")
    o["csv_round_trip"] = _with(RECORDS) + f"""SELECT row_id, {plain},
  CASE WHEN row_id % 7 <> 0 THEN concat(job, ', "q"') END AS job FROM records"""
    o["stage_round_trip"] = _with() + "SELECT row_id, amt, job FROM txn"
    o["csv_bad_rows"] = _with() + """SELECT CASE WHEN row_id % 7 <> 0 THEN row_id END AS row_id,
  CASE WHEN row_id % 7 <> 0 THEN category END AS category,
  CASE WHEN row_id % 7 = 0 THEN concat(row_id, ',', category, ',extra') END AS record FROM txn"""
    o["csv_heading_line"] = _with() + "SELECT row_id, job FROM txn"
    o["csv_line_breaks"] = _with() + \
        """SELECT row_id, concat(' ', category, chr(10), '"', gender, '" ') AS text FROM txn"""
    o["versioned_dataset"] = _with() + """SELECT row_id, job,
  CASE WHEN row_id % 6 <> 0 THEN concat('00', cc_num % 9) END AS code FROM txn WHERE job IS NOT NULL"""
    numbers = ("row_id", "amt", "zip", "lat", "city_pop", "merch_lat", "merch_long", "is_fraud")
    words = ("trans_date_trans_time", "category", "gender", "city", "state", "job", "dob")
    o["load_and_profile"] = _with(RECORDS) + _union(
        [_numbers("records", c, text=True) for c in numbers]
        + [_numbers("records", '"long"', "long", text=True)]
        + [_text("records", c, True) for c in words])
    o["run_stages"] = _with(RECORDS, _split("records", "is_fraud", _ROW_KEY, 42, 0.2, 0.2)) + \
        "SELECT split, count(*) AS n FROM parts WHERE split <> 'train' GROUP BY split"
    o["run_steps"] = _with(RECORDS) + \
        "SELECT row_id, amt, job, true AS has_class FROM records"
    good = "row_id % 13 <> 0 AND row_id % 17 <> 0"
    o["json_records"] = _with(RECORDS) + f"SELECT {_FIELDS} FROM records WHERE {good}"
    o["json_rejected"] = _with() + f"""SELECT row_id, concat_ws('; ',
  CASE WHEN row_id % 17 = 0 THEN 'amt: not float' END,
  CASE WHEN row_id % 13 = 0 THEN 'zip: missing' END) AS reason
  FROM txn WHERE NOT ({good})"""

    # models: what must hold of any, and a rule that a tree finds exactly
    held = _with(RECORDS, _split("records", "is_fraud", _ROW_KEY, 42, 0.2, 0.2))
    for kind in ("train_decision_tree", "train_random_forest", "train_gradient_boosting"):
        o[kind] = held + """SELECT split, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS n_frauds,
  true AS adds_up, true AS follows, true AS repeats FROM parts WHERE split <> 'train' GROUP BY split"""
    o["tune_random_search"] = held + """SELECT count(*) AS n_valid, CAST(sum(is_fraud) AS BIGINT) AS n_frauds,
  CAST(25 AS BIGINT) AS n_trials, true AS in_range, true AS best_is_highest FROM parts WHERE split = 'valid'"""
    o["tune_halving_search"] = held + """SELECT count(*) AS n_valid, CAST(25 AS BIGINT) AS n_first, CAST(8 AS BIGINT) AS n_second,
  CAST(2 AS BIGINT) AS n_last, true AS third_of_rows, true AS not_below FROM parts WHERE split = 'valid'"""
    late = "CAST(substr(trans_date_trans_time, 12, 2) AS INT) >= 12"
    o["score_table"] = _with(RECORDS) + f"""SELECT row_id, amt, CASE WHEN {late} THEN 1 ELSE 0 END AS prediction,
  CASE WHEN {late} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction_proba FROM records"""
    o["score_threshold"] = _with() + _union([
        f"SELECT {t}::DOUBLE AS threshold, count(*) AS n_rows, count(*) AS n_consistent FROM txn"
        for t in ("0.05", "0.5", "0.99")])
    by_hour = f"hours AS (SELECT * REPLACE (CASE WHEN {late} THEN 1 ELSE 0 END AS is_fraud) FROM records)"
    o["evaluate_saved_model"] = _with(RECORDS, by_hour, _split("hours", "is_fraud", _ROW_KEY, 42, 0.2, 0.2)) + \
        "SELECT count(*) AS n, " + ", ".join(
            f"1.0::DOUBLE AS {c}" for c in ("accuracy", "precision", "recall", "f1_score", "auc_roc", "auc_roc_proba")) + \
        " FROM parts WHERE split = 'test'"
    stored = """coded AS (SELECT row_id, is_fraud, amt, city_pop, lat,
  CAST(substr(trans_date_trans_time, 12, 2) AS INT) AS hour FROM records)"""
    o["preprocess_job"] = _with(RECORDS, stored, _split("coded", "is_fraud", _ROW_KEY, 42, 0.2, 0.2)) + \
        "SELECT row_id, is_fraud, split, " + ", ".join(
            f"{_scaled(c, 'coded')} AS {c}" for c in ("amt", "city_pop", "hour")) + " FROM parts"

    # scoring, as far as SQL can state it
    o["score_properties"] = _with() + """SELECT count(*) AS n_rows, round(sum(amt), 2) AS sum_amt,
  count(*) AS n_consistent, count(*) AS n_repeated FROM txn"""
    o["score_stream"] = _with() + f"""SELECT count(*) FILTER ({good}) AS n_scored,
  count(*) FILTER (NOT ({good})) AS n_rejected, CAST(0 AS BIGINT) AS n_different FROM txn"""
    o["score_file"] = _with(RECORDS) + \
        "SELECT row_id, trans_date_trans_time, amt, zip, true AS has_class FROM records"

    # the larger table
    o["lineitem_describe"] = _union([
        _numbers("lineitem", c, text=True)
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ] + [_text("lineitem", "l_returnflag", True)])
    o["lineitem_quartiles_narrowed"] = "SELECT count(*) AS n, " + ", ".join(
        f"round(quantile_cont(l_extendedprice, {p}), 4) AS p{int(p * 100)}"
        for p in (0.25, 0.5, 0.75)) + " FROM lineitem"
    o["lineitem_quartiles_counted"] = _union([
        f"""SELECT '{c}' AS "column", """ + ", ".join(
            f"round(quantile_cont({c}, {p}), 4) AS p{int(p * 100)}" for p in (0.25, 0.5, 0.75))
        + " FROM lineitem" for c in ("l_quantity", "l_tax")])
    o["lineitem_duplicates"] = """SELECT count(*) AS n_rows, count(*) - (SELECT count(*) FROM
  (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS n_duplicates FROM lineitem"""
    o["lineitem_fingerprint"] = "WITH " + _fingerprint(
        "lineitem", [*_LINE_ID, "l_returnflag", "l_linestatus"])
    ids = ", ".join(_LINE_ID)
    o["lineitem_scale"] = f"""SELECT {ids}, {_scaled('l_quantity', 'lineitem')} AS l_quantity,
  {_scaled('l_extendedprice', 'lineitem')} AS l_extendedprice FROM lineitem"""
    o["lineitem_split"] = "WITH " + _split(
        "lineitem", "l_returnflag", _LINE_KEY, 42, 0.2, 0.2) + \
        f"\nSELECT {ids}, l_returnflag, split FROM parts"
    return o
