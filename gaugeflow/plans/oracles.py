"""The same results in ANSI SQL over the given tables, written apart from the queries."""

from __future__ import annotations

import json

from gaugeflow.plans.fixed_model import FIXED
from gaugeflow.sources.endpoint_config import packaged_text

CONFIG = json.loads(packaged_text())
FAMILIES = json.loads(packaged_text("sensor_families.json"))
CATEGORIES = [c["name"] for c in CONFIG["categories"]]
SENSORS = [s["name"] for s in CONFIG["sensors"]]
MEMBERS = ", ".join([*CATEGORIES, *SENSORS])


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _double(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)"


def _draw(i: int) -> str:
    mixed = f"event_id * {7919 + 2 * i} + user_id * 104729 + {i * 1299709}"
    return f"(CAST(({mixed}) % 10007 AS DOUBLE) / {_double(10007.0)})"


def _spread(i: int) -> str:
    return f"({_double(2.0)} * {_draw(i)} - {_double(1.0)})"


def _label(rate: float) -> str:
    return f"CASE WHEN {_draw(0)} < {_double(rate)} THEN 1 ELSE 0 END"


def _ladder(draw: str, levels: list[str], thresholds: list[float]) -> str:
    steps = " ".join(
        f"WHEN {draw} < {_double(t)} THEN {_text(x)}" for x, t in zip(levels, thresholds)
    )
    return f"CASE {steps} END"


def _level(j: int) -> str:
    c = CONFIG["categories"][j]
    one = _ladder(_draw(1 + j), c["levels"], c["oneThresholds"])
    zero = _ladder(_draw(1 + j), c["levels"], c["zeroThresholds"])
    return f"CASE WHEN Result = 1 THEN {one} ELSE {zero} END"


def _noisy(j: int) -> str:
    names = CONFIG["categories"][j]["levels"]
    listed = ", ".join(_text(n) for n in names)
    pick = f"CAST(floor({_draw(27 + j)} * {len(names)}) AS INTEGER) + 1"
    rate = _double(CONFIG["errorRate"])
    return f"CASE WHEN {_draw(19 + j)} < {rate} THEN ([{listed}])[{pick}] ELSE {_level(j)} END"


def _raw(sensor: dict, j: int) -> str:
    def moments(side: str) -> str:
        std, mean = _double(sensor[f"{side}StdDev"]), _double(sensor[f"{side}Mean"])
        return f"{_spread(9 + j)} * {std} + {mean}"

    by_label = "CASE WHEN Result = 1 THEN {} ELSE {} END"
    return {
        0: by_label.format(moments("one"), moments("zero")),
        1: by_label.format(moments("zero"), moments("one")),
        2: moments("one"),
        3: _draw(9 + j),
    }.get(sensor["simulatorType"], "CAST(NULL AS DOUBLE)")


def _whole(value: str, scale: float) -> str:
    thousandths = f"floor({_double(1000.0 * scale)} * ({value}) + {_double(0.5)})"
    # The sum turns a negative zero into zero.
    return f"(trunc({thousandths} / 1000) + 0)"


def _code(j: int) -> str:
    names = CONFIG["categories"][j]["levels"]
    steps = " ".join(f"WHEN {_text(n)} THEN {i}" for i, n in enumerate(names))
    return f"CASE {CATEGORIES[j]} {steps} END"


def _records(noise: bool = False) -> str:
    """A WITH list that ends in `records`: ids, time, label, level names, readings."""
    level = _noisy if noise else _level
    columns = [f"{level(j)} AS {name}" for j, name in enumerate(CATEGORIES)]
    columns += [
        f"{_whole(_raw(s, j), s['scale'])} AS {s['name']}" for j, s in enumerate(CONFIG["sensors"])
    ]
    return f"""WITH labelled AS (
  SELECT *, {_label(CONFIG["successRate"])} AS Result FROM events
), records AS (
  SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS CurrentTime,
    Result, {", ".join(columns)}
  FROM labelled
)"""


def _coded(noise: bool = False) -> str:
    """`_records`, then `coded` with level numbers instead of names."""
    codes = ", ".join(f"{_code(j)} AS {name}" for j, name in enumerate(CATEGORIES))
    return f"""{_records(noise)}, coded AS (
  SELECT event_id, event_type, CurrentTime, Result, {codes}, {", ".join(SENSORS)} FROM records
)"""


def _messages(noise: bool = False, coded: bool = False, topic: str = "'epd01'") -> str:
    """`_records`, then `messages` with key, value, topic, partition, offset."""
    quote = "" if coded else '"'
    categories = " || ',' || ".join(
        f"""'"{name}":{quote}' || {name} || '{quote}'""" for name in CATEGORIES
    )
    sensors = " || ',' || ".join(
        f"""'"{name}":' || CAST(CAST({name} AS BIGINT) AS VARCHAR) || '.0'""" for name in SENSORS
    )
    value = f"""'{{"CurrentTime":"' || CurrentTime || '","Topic":"' || {topic}
      || '","Result":' || Result || ',"Categories":{{' || {categories}
      || '}},"Sensors":{{' || {sensors} || '}}}}'"""
    return f"""{_coded(noise) if coded else _records(noise)}, messages AS (
  SELECT CAST(event_id AS VARCHAR) AS "key", {value} AS "value", {topic} AS topic,
    CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 4 AS "offset"
  FROM {"coded" if coded else "records"}
)"""


def _damaged() -> str:
    """`_messages`, then `damaged`, spoiled by offset; `doc` is null unless JSON."""
    return f"""{_messages()}, spoiled AS (
  SELECT "key", topic, "partition", "offset", CASE "offset" % 32
      WHEN 0 THEN substr("value", 1, 100)
      WHEN 1 THEN ''
      WHEN 2 THEN NULL
      WHEN 3 THEN '12'
      WHEN 4 THEN '[1]'
      WHEN 5 THEN '{{"Result":1}}'
      WHEN 6 THEN replace("value", '"cat0":"', '"cat0":"un')
      WHEN 7 THEN "value" || ' garbage'
      WHEN 8 THEN "value" || "value"
      WHEN 9 THEN replace("value", '"', '''')
      WHEN 10 THEN '{{"Result":0,' || substr("value", 2)
      WHEN 11 THEN replace("value", '"sensor0":', '"sensor0":1e999,"other":')
      WHEN 12 THEN replace("value", '"sensor0":', '"sensor0":"Infinity","other":')
      WHEN 13 THEN regexp_replace("value", '"Result":[01]', '"Result":7')
      WHEN 14 THEN regexp_replace("value", '"Result":[01]', '"Result":-1')
      ELSE "value" END AS "value"
  FROM messages
), damaged AS (
  SELECT *, CASE WHEN json_valid("value") THEN "value" END AS doc FROM spoiled
)"""


_JSON_STATUS = """CASE WHEN "value" IS NULL OR trim("value") = '' THEN 'blank'
  WHEN NOT json_valid("value") THEN 'malformed'
  WHEN json_type(doc) <> 'OBJECT' THEN 'not_object' END"""


def _record_status() -> str:
    """`_damaged`, then `judged` with a status for each message."""
    good = " AND ".join(
        [
            "json_extract_string(doc, '$.Result') IN ('0', '1')",
            *[
                f"json_extract_string(doc, '$.Categories.{c['name']}') IN "
                f"({', '.join(_text(n) for n in c['levels'])})"
                for c in CONFIG["categories"]
            ],
            *[
                f"COALESCE(json_extract_string(doc, '$.Sensors.{name}') NOT IN ('1e999', 'Infinity', 'inf'), FALSE)"
                for name in SENSORS
            ],
        ]
    )
    return f"""{_damaged()}, judged AS (
  SELECT "key", COALESCE({_JSON_STATUS}, CASE WHEN {good} THEN 'ok' ELSE 'bad_field' END) AS status
  FROM damaged
)"""


def _scored() -> str:
    """`_coded` with noise, then `scored` with margin, probability and prediction."""
    terms = " + ".join(
        f"{_double(c)} * {name}" for c, name in zip(FIXED.coefficients, FIXED.features)
    )
    return f"""{_coded(noise=True)}, margins AS (
  SELECT *, {_double(FIXED.intercept)} + {terms} AS margin FROM coded
), probabilities AS (
  SELECT *, 1 / (1 + exp(-margin)) AS probability FROM margins
), scored AS (
  SELECT *, CASE WHEN probability > 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM probabilities
)"""


_POSITION = 'topic, "partition", "offset"'
_CONSUMED = """'Consumer: topic = ' || topic || ', partition = ' || "partition" ||
  ', offset = ' || "offset" || ', key = ' || "key" || ' ' || chr(10) || "value\""""
_ID = """topic || '-' || "partition" || '-' || "offset\""""


def _config_levels() -> str:
    rows = [
        f"({_text(c['name'])}, {i}, {_text(name)}, {_double(one)}, {_double(zero)})"
        for c in CONFIG["categories"]
        for i, (name, one, zero) in enumerate(
            zip(c["levels"], c["oneThresholds"], c["zeroThresholds"])
        )
    ]
    seen = " UNION ALL ".join(
        f"SELECT '{name}' AS category, {name} AS level, Result FROM records" for name in CATEGORIES
    )
    return f"""{_records()}, seen AS ({seen}), counts AS (
  SELECT category, level, count(*) FILTER (Result = 1) AS n_one,
    count(*) FILTER (Result = 0) AS n_zero
  FROM seen GROUP BY category, level
), config(category, level_no, level, one_threshold, zero_threshold) AS (VALUES {", ".join(rows)})
SELECT config.*, COALESCE(n_one, 0) AS n_one, COALESCE(n_zero, 0) AS n_zero
FROM config LEFT JOIN counts USING (category, level)"""


def _config_sensors() -> str:
    moments = ["scale", "oneMean", "oneStdDev", "zeroMean", "zeroStdDev"]
    rows = [
        f"({i}, {_text(s['name'])}, {s['simulatorType']}, "
        f"{', '.join(_double(s[m]) for m in moments)})"
        for i, s in enumerate(CONFIG["sensors"])
    ]
    seen = " UNION ALL ".join(f"SELECT '{n}' AS name, {n} AS reading FROM records" for n in SENSORS)
    named = ", ".join(f'"{m}"' for m in moments)
    return f"""{_records()}, seen AS ({seen}), measured AS (
  SELECT name, count(reading) AS n_readings, min(reading) AS min_reading,
    max(reading) AS max_reading, round(avg(reading), 6) AS mean_reading
  FROM seen GROUP BY name
), config(sensor_no, name, "simulatorType", {named}) AS (VALUES {", ".join(rows)})
SELECT config.*, n_readings, min_reading, max_reading, mean_reading
FROM config LEFT JOIN measured USING (name)"""


def _score_auc() -> str:
    return f"""{_scored()}, by_score AS (
  SELECT margin, count(*) FILTER (Result = 1) AS ones, count(*) FILTER (Result = 0) AS zeros
  FROM scored GROUP BY margin
), ranked AS (
  SELECT ones, zeros, COALESCE(sum(zeros) OVER (
    ORDER BY margin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM by_score
)
SELECT CAST(sum(ones) AS BIGINT) AS n_ones, CAST(sum(zeros) AS BIGINT) AS n_zeros,
  round(CAST(sum(ones * (2 * below + zeros)) AS DOUBLE)
    / (2 * CAST(sum(ones) AS DOUBLE) * CAST(sum(zeros) AS DOUBLE)), 9) AS auc
FROM ranked"""


def _part(identity: str) -> str:
    digest = f"substr(md5('42:' || {identity}), 1, 8)"
    return f"CASE WHEN CAST('0x' || {digest} AS BIGINT) % 100 < 80 THEN 'train' ELSE 'test' END"


def _scored_line() -> str:
    values = " || ',' || ".join(
        f"CAST(CAST({name} AS BIGINT) AS VARCHAR) || '.0'" for name in [*CATEGORIES, *SENSORS]
    )
    predicted = "CASE WHEN prediction = 1 THEN '1.0' ELSE '0.0' END"
    return (
        f"'Time: ' || CurrentTime || ', Features: [' || {values} || '], Actual: ' || Result "
        f"|| ', Predicted: ' || {predicted} || '  '"
    )


def _fitted(steps: int = 600, momentum: float = 0.9) -> str:
    """`_coded` with noise, then `fitted`: the elastic net of the training rows by accelerated
    proximal steps on standardised features, whose loss has one minimum."""
    names = [*CATEGORIES, *SENSORS]
    absolute, square = 0.02 * 0.8, 0.02 * (1 - 0.8)
    # Steps that no loss with so many standardised features and an intercept can outrun.
    pace = 4 / (len(names) + 1)

    def each(form: str, between: str = ", ") -> str:
        return between.join(form.format(j=j, n=n) for j, n in enumerate(names))

    margin = f"vb + {each('v{j} * z{j}', ' + ')}"
    soft = f"sign(u{{j}}) * greatest(abs(u{{j}}) - {_double(absolute * pace)}, 0) AS n{{j}}"
    on = _double(momentum)
    return f"""{_coded(noise=True).replace("WITH ", "WITH RECURSIVE ", 1)}, base AS (
  SELECT Result AS y, {each("CAST({n} AS DOUBLE) AS x{j}")} FROM coded WHERE {_part("event_id")} = 'train'
), shape AS (
  SELECT {each("avg(x{j}) AS m{j}")}, {each("stddev_samp(x{j}) AS s{j}")} FROM base
), standard AS (
  SELECT y, {each("CASE WHEN s{j} > 0 THEN (x{j} - m{j}) / s{j} ELSE 0 END AS z{j}")} FROM base, shape
), fit AS (
  SELECT 0 AS step, 0::DOUBLE AS wb, 0::DOUBLE AS vb, {each("0::DOUBLE AS w{j}")}, {each("0::DOUBLE AS v{j}")}
  UNION ALL
  SELECT step + 1, nb, nb + {on} * (nb - wb), {each("n{j}")}, {each("n{j} + " + on + " * (n{j} - w{j})")}
  FROM (
    SELECT step, wb, {each("w{j}")}, nb, {each(soft)} FROM (
      SELECT step, wb, {each("w{j}")}, vb - {_double(pace)} * avg(gap) AS nb,
        {each("v{j} - " + _double(pace) + " * (avg(gap * z{j}) + " + _double(square) + " * v{j}) AS u{j}")}
      FROM (
        SELECT fit.*, {each("z{j}")}, 1 / (1 + exp(-({margin}))) - y AS gap FROM fit, standard WHERE step < {steps}
      ) GROUP BY step, wb, vb, {each("w{j}")}, {each("v{j}")}
    )
  )
), fitted AS (
  SELECT {each("CASE WHEN s{j} > 0 THEN w{j} / s{j} ELSE 0 END AS c{j}")},
    wb - ({each("CASE WHEN s{j} > 0 THEN w{j} * m{j} / s{j} ELSE 0 END", " + ")}) AS cb,
    {_double(absolute)} * ({each("abs(w{j})", " + ")}) + {_double(square / 2)} * ({each("w{j} * w{j}", " + ")}) AS penalty
  FROM fit, shape WHERE step = {steps}
)"""


def _coefficients() -> str:
    named = [*((n, f"c{j}") for j, n in enumerate([*CATEGORIES, *SENSORS])), ("intercept", "cb")]
    rows = " UNION ALL ".join(f"SELECT '{n}' AS feature, {c} AS c FROM fitted" for n, c in named)
    return f"{_fitted()} SELECT feature, round(c, 2) + 0 AS coefficient FROM ({rows})"


def _optimality() -> str:
    named = [*((n, f"c{j}") for j, n in enumerate([*CATEGORIES, *SENSORS])), ("intercept", "cb")]
    rows = " UNION ALL ".join(f"SELECT '{n}' AS feature, {c} AS c FROM fitted" for n, c in named)
    margin = " + ".join(f"c{j} * x{j}" for j in range(len(named) - 1))
    return f"""{_fitted()}, losses AS (
  SELECT avg(ln(1 + exp(-abs(cb + {margin}))) + greatest(CASE WHEN y = 1 THEN -1 ELSE 1 END * (cb + {margin}), 0))
    + any_value(penalty) AS loss FROM base, fitted
)
SELECT feature, CAST(sign(CASE WHEN abs(c) < 1e-12 THEN 0 ELSE c END) AS INTEGER) AS sign, TRUE AS optimal,
  round(loss, 6) AS loss FROM ({rows}), losses"""


def oracle_sql() -> dict[str, str]:
    typed = f"""{_messages()} SELECT "key", "value", {_POSITION} FROM messages"""
    in_scored = "round(margin, 6) AS margin, round(probability, 6) AS probability, prediction"
    return {
        "stream_subscribe": typed,
        "stream_topic_set": f"""{_messages(topic="event_type")}
SELECT "key", "value", {_POSITION} FROM messages WHERE topic IN ('click', 'view')""",
        "offset_range": f"""{typed} WHERE "partition" = 0
  OR ("partition" = 1 AND "offset" >= 100) OR ("partition" = 2 AND "offset" >= 7)""",
        "resume_no_dup": f"""{_messages()} SELECT "key", {_POSITION} FROM messages""",
        "collection_scan": f"{_records()} SELECT CurrentTime, Result, {MEMBERS} FROM records",
        "config_levels": _config_levels(),
        "config_sensors": _config_sensors(),
        "publish_envelope": f"""{_messages(topic="event_type")}
SELECT topic, "key", "value" FROM messages""",
        "delivery_report": f"""{_messages(topic="event_type")}
SELECT "key", 'topic=' || topic || '  partition=' || "partition" || '  offset=' || "offset"
  || ': ' || chr(10) || "value" AS line FROM messages""",
        "archive_append": f"""{_damaged()} SELECT {_ID} AS _id, "key",
  COALESCE({_JSON_STATUS}, 'ok') AS status, "value" FROM damaged""",
        "train_documents": f"""{_record_status()}, named AS (
  SELECT CAST(event_id AS VARCHAR) AS "key",
    'epd01-' || (event_id % 4) || '-' || (event_id // 4) AS _id, * FROM records
)
SELECT CurrentTime, Result AS label,
  {", ".join(f"{_code(j)} AS {n}" for j, n in enumerate(CATEGORIES))},
  {", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in SENSORS)},
  {_part("_id")} AS part
FROM named JOIN judged USING ("key") WHERE status = 'ok'""",
        "archive_batched": f"""{_messages()} SELECT {_ID} AS _id, "key", "value" FROM messages""",
        "fan_out": f"""{_messages()}
SELECT 'console' AS sink, "key", {_CONSUMED} AS line FROM messages
UNION ALL SELECT 'store' AS sink, "key", "value" AS line FROM messages""",
        "record_line": f"""{_messages()} SELECT "key", {_CONSUMED} AS consumed,
  'Consumer record: key=' || "key" || chr(10) || "value" AS archived FROM messages""",
        "scored_rows": f"""{_scored()}
SELECT CurrentTime, Result AS label, prediction, {_scored_line()} AS line FROM scored""",
        "envelope_cast": f"""{_messages()} SELECT "key", "value" FROM messages""",
        "json_decode": f"""{_coded()} SELECT CAST(event_id AS VARCHAR) AS "key", CurrentTime,
  'epd01' AS Topic, Result, {MEMBERS} FROM coded""",
        "json_rejects": f"""{_record_status()} SELECT "key", status FROM judged""",
        "document_field": """SELECT event_id,
  CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events""",
        "nested_extract": f"""{_records()} SELECT CurrentTime, 'epd01' AS Topic, Result,
  cat1, sensor9 FROM records""",
        "struct_flatten": f"{_records()} SELECT CurrentTime, Result, {MEMBERS} FROM records",
        "drop_rename": f"""{_records()} SELECT CAST(event_id AS VARCHAR) AS "key", CurrentTime,
  Result AS label FROM records""",
        "json_encode": f"""{_messages(coded=True)} SELECT "key", "value" FROM messages""",
        "time_text": """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS wall_time FROM events""",
        "group_readings": f"""{_records()} SELECT event_id, {len(CATEGORIES)} AS n_categories,
  {len(SENSORS)} AS n_sensors, {MEMBERS} FROM records""",
        "encode_levels": f"{_coded()} SELECT event_id, {', '.join(CATEGORIES)} FROM coded",
        "assemble_features": f"""{_coded(noise=True)} SELECT event_id, Result AS label, {
            ", ".join(
                f"CAST({n} AS DOUBLE) AS f{i}" for i, n in enumerate([*CATEGORIES, *SENSORS])
            )
        } FROM coded""",
        "random_split_counts": """SELECT count(*) AS n_rows, count(*) AS n_split,
  TRUE AS same_rows, TRUE AS share_ok FROM events""",
        "key_split": f"SELECT event_id, {_part('event_id')} AS part FROM events",
        "lr_coefficients": _coefficients(),
        "lr_optimality": _optimality(),
        "reload_parity": f"""SELECT count(*) AS n_scored, CAST(0 AS BIGINT) AS n_differing
FROM events WHERE {_part("event_id")} = 'test'""",
        "score_batch": f"""{_scored()} SELECT CAST(event_id AS VARCHAR) AS "key",
  Result AS label, {in_scored} FROM scored""",
        "score_stream": f"""{_scored()} SELECT CAST(event_id AS VARCHAR) AS "key",
  Result AS label, {in_scored}, 'ok' AS status FROM scored""",
        "hard_label_auc": f"""{_scored()}, counts AS (
  SELECT count(*) FILTER (Result = 1 AND prediction = 1) AS tp,
    count(*) FILTER (Result = 1 AND prediction = 0) AS fn,
    count(*) FILTER (Result = 0 AND prediction = 1) AS fp,
    count(*) FILTER (Result = 0 AND prediction = 0) AS tn FROM scored
)
SELECT *, round((CAST(tp AS DOUBLE) / (tp + fn) + CAST(tn AS DOUBLE) / (tn + fp)) / 2, 9) AS auc
FROM counts""",
        "score_auc": _score_auc(),
        "gen_label": f"SELECT event_id, {_label(CONFIG['successRate'])} AS label FROM events",
        "gen_reading": f"""WITH labelled AS (
  SELECT *, {_label(FAMILIES["successRate"])} AS Result FROM events
)
SELECT event_id, Result AS label, {
            ", ".join(
                f"round({_raw(s, j)}, 9) AS {s['name']}" for j, s in enumerate(FAMILIES["sensors"])
            )
        } FROM labelled""",
        "quantise": f"""SELECT event_id,
  CAST(floor({_double(25.0)} * ("value" - {_double(20.0)}) + {_double(0.5)}) AS BIGINT) AS fine,
  {_whole(f'"value" - {_double(20.0)}', 2.5)} AS coarse FROM events""",
        "threshold_level": f"{_records()} SELECT event_id, Result, {', '.join(CATEGORIES)} FROM records",
        "noisy_level": f"{_records(noise=True)} SELECT event_id, {', '.join(CATEGORIES)} FROM records",
        "gen_records": f"""{_messages(noise=True)} SELECT topic, "key", "value" FROM messages""",
        "publish_stream": f"""{_messages(topic="event_type")}
SELECT topic, "partition", "key", "value", count(*) OVER run AS n, count(*) OVER run AS n_places,
  CAST(0 AS BIGINT) AS first, count(*) OVER run - 1 AS last
FROM messages WINDOW run AS (PARTITION BY topic, "partition")""",
        "publish_report": f"""{_messages(topic="event_type")}, halves AS (
  SELECT *, "offset" % 2 AS half, count(*) FILTER ("offset" % 2 = 0) OVER (PARTITION BY topic, "partition") AS before,
    row_number() OVER (PARTITION BY topic, "partition", "offset" % 2 ORDER BY "offset") - 1 AS own,
    count(*) OVER (PARTITION BY topic, "partition", "offset" % 2) AS n FROM messages
)
SELECT "key", topic, "partition", before AS first, before + n AS next, n, 'topic=' || topic || '  partition=' || "partition"
  || '  offset=' || (before + own) || ': ' || chr(10) || "value" AS line FROM halves WHERE half = 1""",
        "offset_stream": f"""{typed} WHERE "partition" = 0 OR ("partition" = 1 AND "offset" >= 100)
  OR ("partition" = 2 AND "offset" >= 7) OR ("partition" = 3 AND "offset" >= 200)""",
        "insert_sizes": f"""{_messages()} SELECT "partition", CAST("offset" // 10 AS INTEGER) AS insert_no,
  count(*) AS size FROM messages GROUP BY ALL""",
        "committed_places": f"""{_messages(topic="event_type")} SELECT topic, "partition",
  count(*) FILTER ("offset" < 100) AS committed, count(*) FILTER ("offset" >= 100) AS behind
FROM messages WHERE topic IN ('click', 'view') GROUP BY ALL""",
        "inferred_scan": f"{_records()} SELECT CurrentTime, Result, {MEMBERS} FROM records",
        "inferred_mixed": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'STRING'
    WHEN 2 THEN 'ARRAY<BIGINT>' END AS kind,
  CASE event_id % 4 WHEN 0 THEN user_id::VARCHAR WHEN 1 THEN '"' || event_type || '"'
    WHEN 2 THEN '[' || user_id || ']' END AS tag FROM events""",
        "fan_out_whole": f"""{_messages()}
SELECT 'console' AS sink, "key", {_CONSUMED} AS line, CAST(0 AS BIGINT) AS n_before FROM messages
UNION ALL SELECT 'store' AS sink, "key", "value" AS line, CAST(0 AS BIGINT) AS n_before FROM messages""",
        "mode_switch": f"""{_record_status()}
SELECT 'archive' AS mode, COALESCE({_JSON_STATUS}, 'ok') AS status, count(*) AS n
FROM damaged GROUP BY 2
UNION ALL SELECT 'score' AS mode, status, count(*) AS n FROM judged GROUP BY 2""",
    }
