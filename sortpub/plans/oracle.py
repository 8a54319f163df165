"""DuckDB SQL equal to every registered query (run on the driver's tables).

The views of ``sortpub.plans.views`` are restated as CTEs; DuckDB's ``trim`` with a
character set matches the Unicode white-space trim, ``string_split`` plus a list
slice matches the 4-field split, and a full-match guard keeps TRY_CAST strict.
"""

from __future__ import annotations

from sortpub.domains import ADDRESS_LEN, ALNUM_SPACE, CONTINENTS, DIGITS, ID_MAX, ID_MIN, LETTERS, NAME_LEN
from sortpub.functions.text import WHITESPACE_CODEPOINTS
from sortpub.plans.queries import PEEK_N, RUN_CHUNK, TOP_N
from sortpub.sources.generate import CHOICES, PER_WORD, WORDS

WS = "(" + " || ".join(f"chr({c})" for c in WHITESPACE_CODEPOINTS) + ")"


def _trim(x: str) -> str:
    return f"trim({x}, {WS})"


def _ser(prefix: str = "") -> str:
    return (f"concat_ws(',', CAST({prefix}id AS VARCHAR), {prefix}name, {prefix}address, "
            f"{prefix}continent)")


def _strict(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '[+-]?[0-9]+') THEN TRY_CAST({x} AS INTEGER) END"


PEOPLE = """people AS (
  SELECT o.o_orderkey,
         CAST(o.o_custkey % 2147483648 AS INTEGER) AS id,
         c.c_name AS name,
         CAST(o.o_orderkey AS VARCHAR) || ' ' || o.o_orderpriority AS address,
         r.r_name AS continent
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

LINES = f"""lines AS (
  SELECT o_orderkey,
    CASE o_orderkey % 50
      WHEN 0 THEN ''
      WHEN 1 THEN concat_ws(',', CAST(id AS VARCHAR), name)
      WHEN 2 THEN concat_ws(',', '3.14', name, address, continent)
      WHEN 3 THEN concat_ws(',', '99999999999', name, address, continent)
      WHEN 4 THEN {_ser()} || ', x,y ,z'
      WHEN 5 THEN chr(9) || chr(160) || CAST(id AS VARCHAR) || chr(160) || ',' || chr(133) || name
                  || chr(9) || ',' || address || chr(12288) || ',' || continent || chr(160) || chr(9)
      WHEN 6 THEN '+' || {_ser()}
      ELSE {_ser()}
    END AS value
  FROM people)"""

PARSED = f"""split AS (
  SELECT o_orderkey, value, string_split(value, ',') AS p FROM lines),
fields AS (
  SELECT o_orderkey, value, len(p) >= 4 AS ok,
         {_trim('p[1]')} AS f0, {_trim('p[2]')} AS f1, {_trim('p[3]')} AS f2,
         {_trim("array_to_string(p[4:], ',')")} AS f3
  FROM split),
parsed AS (
  SELECT o_orderkey, value,
         CASE WHEN ok THEN {_strict('f0')} END AS id,
         CASE WHEN ok THEN f1 END AS name,
         CASE WHEN ok THEN f2 END AS address,
         CASE WHEN ok THEN f3 END AS continent,
         ok
  FROM fields),
valid AS (
  SELECT o_orderkey, id, name, address, continent FROM parsed WHERE ok AND id IS NOT NULL)"""

WITH_PEOPLE = f"WITH {PEOPLE}\n"
WITH_LINES = f"WITH {PEOPLE},\n{LINES}\n"
WITH_VALID = f"WITH {PEOPLE},\n{LINES},\n{PARSED}\n"


def _rank(key: str, rest: list[str]) -> str:
    return f"row_number() OVER (ORDER BY {', '.join([key, *rest])}) - 1"


def _sorted(key: str) -> str:
    rest = [c for c in ("id", "name", "address", "continent") if c != key]
    return f"""{WITH_VALID}SELECT {_rank(key, rest)} AS "offset", id, name, address, continent FROM valid"""


def _sorted_values(key: str) -> str:
    rest = [c for c in ("id", "name", "address", "continent") if c != key]
    return f"""SELECT '{key}' AS sort_key, {_rank(key, rest)} AS "offset", {_ser()} AS value FROM valid"""


KEPT = f"""kept AS (
  SELECT o_orderkey, {_trim('value')} AS value FROM lines
  WHERE {_trim('value')} <> ''
    AND length({_trim('value')}) - length(replace({_trim('value')}, ',', '')) >= 3)"""

PUBLISHED = f"""{KEPT},
published AS (
  SELECT CAST(pos % 3 AS INTEGER) AS partition, CAST(pos // 3 AS BIGINT) AS "offset", value
  FROM (SELECT value, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM kept))"""

EVENT_TOPIC = """event_topic AS (
  SELECT CAST(event_id % 3 AS INTEGER) AS partition, CAST(event_id // 3 AS BIGINT) AS "offset",
         concat_ws(',', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), event_type) AS value,
         ts AS "timestamp"
  FROM events)"""

ARRIVAL = """arrival AS (
  SELECT o_orderkey AS position, id, name, address, continent FROM valid),
runs AS (
  SELECT CAST(floor(position / {chunk}) AS BIGINT) AS run,
         row_number() OVER (PARTITION BY CAST(floor(position / {chunk}) AS BIGINT)
                            ORDER BY id, name, address, continent, position) - 1 AS rank,
         position, id, name, address, continent
  FROM arrival)""".format(chunk=RUN_CHUNK)

_CONTINENTS = ", ".join(f"'{c}'" for c in CONTINENTS)
DOMAIN_RULES = {
    "id_range": f"id BETWEEN {ID_MIN} AND {ID_MAX - 1}",
    "name_length": f"length(name) BETWEEN {NAME_LEN[0]} AND {NAME_LEN[1]}",
    "name_letters": "regexp_full_match(name, '[A-Za-z]+')",
    "address_length": f"length(address) BETWEEN {ADDRESS_LEN[0]} AND {ADDRESS_LEN[1]}",
    "address_digit_first": "regexp_full_match(substring(address, 1, 1), '[0-9]')",
    "address_space_third": "substring(address, 3, 1) = ' '",
    "address_chars": "regexp_full_match(address, '[A-Za-z0-9 ]+')",
    "continent_known": f"continent IN ({_CONTINENTS})",
    "four_fields": f"length({_ser()}) - length(replace({_ser()}, ',', '')) = 3",
}


def _domains() -> str:
    parts = [f"SELECT '{n}' AS rule, count_if(NOT coalesce({r}, false)) AS violations FROM valid"
             for n, r in DOMAIN_RULES.items()]
    return WITH_VALID + "\nUNION ALL\n".join(parts)


def _split4(table: str, key: str, trim: bool) -> str:
    t = _trim if trim else (lambda x: x)
    return f"""SELECT {key}, {'' if trim else 'least(len(p), 4) AS n_fields, '}
  CASE WHEN len(p) >= 1 THEN {t('p[1]')} END AS f0,
  CASE WHEN len(p) >= 2 THEN {t('p[2]')} END AS f1,
  CASE WHEN len(p) >= 3 THEN {t('p[3]')} END AS f2,
  CASE WHEN len(p) >= 4 THEN {t("array_to_string(p[4:], ',')")} END AS f3
FROM (SELECT {key}, string_split(value, ',') AS p FROM {table})"""


# The primes of 64-bit xxHash, and the seed that Spark's xxhash64 begins with.
P1, P2, P3, P4, P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
SPARK_SEED = 42
_FULL = "18446744073709551616::UHUGEINT"


def _xxhash(value: str, seed: str, keep: str) -> list[str]:
    """Steps (select lists) of xxHash of one 64-bit number; the last gives ``h``."""
    rot = lambda x, n: f"(({x} * {1 << n}::UHUGEINT) % {_FULL} + {x} // {1 << (64 - n)}::UHUGEINT)"
    mul = lambda x, p: f"({x} * {p}::UHUGEINT) % {_FULL}"
    shifted = lambda n: f"xor(h, h // {1 << n}::UHUGEINT)"
    return [f"{keep}, {mul(value, P2)} AS h, ({seed} + {P5}::UHUGEINT + 8) % {_FULL} AS s", f"{keep}, {mul(rot('h', 31), P1)} AS h, s",
            f"{keep}, xor(h, s) AS h", f"{keep}, ({mul(rot('h', 27), P1)} + {P4}::UHUGEINT) % {_FULL} AS h", f"{keep}, {shifted(33)} AS h",
            f"{keep}, {mul('h', P2)} AS h", f"{keep}, {shifted(29)} AS h", f"{keep}, {mul('h', P3)} AS h", f"{keep}, {shifted(32)} AS h"]


def _chars(words: list[str], charset: str, n: int) -> list[str]:
    """Characters as SQL; a pair's first letter is its higher digit."""
    k, out = len(charset), []
    for i in range(0, n, 2):
        pair = f"({words[i // PER_WORD]} // {k ** (i % PER_WORD)} % {k * k})"
        out += [f"'{charset}'[{pair} // {k} + 1]", f"'{charset}'[{pair} % {k} + 1]"]
    return out


def _generated() -> str:
    """Records drawn from the order keys with seed 42: five chained hashes (seed, key, counter) each."""
    ctes = [f"g0 AS (SELECT o_orderkey, j, {SPARK_SEED}::UHUGEINT AS h FROM orders, range({WORDS}) r(j))"]
    for value in ("42::UHUGEINT", "o_orderkey::UHUGEINT", "j::UHUGEINT"):
        for step in _xxhash(value, "h", "o_orderkey, j"):
            ctes.append(f"g{len(ctes)} AS (SELECT {step} FROM g{len(ctes) - 1})")
    last = f"g{len(ctes) - 1}"
    words = ", ".join(f"max(CASE WHEN j = {j} THEN (h // 2)::BIGINT END) AS w{j}" for j in range(WORDS))
    part = lambda name: f"(w0 // {CHOICES[name][0]} % {CHOICES[name][1]})"
    name = " || ".join(_chars(["w1", "w2"], LETTERS, NAME_LEN[1] + NAME_LEN[1] % 2))
    text = _chars(["w3", "w4"], ALNUM_SPACE, ADDRESS_LEN[1])
    address = " || ".join([f"'{DIGITS}'[{part('digit')} + 1]", text[1], "' '", *text[3:]])
    return f"""WITH {", ".join(ctes)},
w AS (SELECT o_orderkey, {words} FROM {last} GROUP BY o_orderkey)
SELECT o_orderkey, CAST({part('id')} AS INTEGER) AS id, substr({name}, 1, {NAME_LEN[0]} + {part('name')}) AS name,
  substr({address}, 1, {ADDRESS_LEN[0]} + {part('address')}) AS address, [{_CONTINENTS}][{part('continent')} + 1] AS continent FROM w"""


ORACLES: dict[str, str] = {
    "generate_people": _generated(),
    "line_roundtrip": """WITH base AS (
  SELECT c_custkey % 6 AS k, concat_ws(',', CAST(c_custkey AS VARCHAR), c_name, '1 x', c_mktsegment) AS r FROM customer)
SELECT CASE k WHEN 0 THEN '#' || r WHEN 1 THEN r || chr(1) || 'tail' WHEN 2 THEN '"' || r || '" ' WHEN 3 THEN '  ' || r
              WHEN 4 THEN r || chr(10) || r ELSE r END AS value, k <> 4 AS written FROM base""",
    "csv_roundtrip": f"{WITH_VALID}SELECT id, name, address, continent FROM valid",
    "read_lines": f"{WITH_LINES}SELECT value FROM lines WHERE value <> ''",
    "publish_source": f"{WITH_LINES},\n{PUBLISHED}\nSELECT partition, \"offset\", value FROM published",
    "snapshot_read": f"WITH {EVENT_TOPIC}\nSELECT partition, \"offset\", value, \"timestamp\" FROM event_topic",
    "topic_stats": f"""WITH {EVENT_TOPIC}
SELECT 'event_topic' AS topic, partition, min("offset") AS oldest, max("offset") + 1 AS hwm,
       count(*) AS records
FROM event_topic GROUP BY partition""",
    "stored_stats": f"""WITH {EVENT_TOPIC}
SELECT 'event_topic' AS topic, partition, min("offset") AS oldest, max("offset") + 1 AS hwm, count(*) AS records
FROM event_topic GROUP BY partition""",
    "append_vs_replace": f"""{WITH_VALID},\n{KEPT},
n AS (SELECT count(*) AS k, least(count(*), 3) AS p FROM kept), v AS (SELECT count(*) AS k, least(count(*), 1) AS p FROM valid)
SELECT 'append' AS mode, 2 * k AS records, 2 * k AS distinct_positions, p AS partitions FROM n
UNION ALL SELECT 'overwrite', k, k, p FROM n
UNION ALL SELECT 'ignore', k, k, p FROM n
UNION ALL SELECT 'sorted over lines', k, k, p FROM v""",
    "publish_sorted": f"""{WITH_VALID}SELECT {_rank('id', ['name', 'address', 'continent'])} AS "offset",
  {_ser()} AS value FROM valid""",
    "append_sorted": f"""{WITH_VALID}SELECT {_rank('name', ['id', 'address', 'continent'])} AS "offset", {_ser()} AS value FROM valid""",
    "publish_partitions": f"""{WITH_VALID}SELECT {_rank('continent', ['id', 'name', 'address'])} AS "offset", {_ser()} AS value FROM valid""",
    "peek_sorted": f"""{WITH_VALID},
ranked AS (
  SELECT 'id' AS topic, {_rank('id', ['name', 'address', 'continent'])} AS "offset", {_ser()} AS value FROM valid
  UNION ALL
  SELECT 'name', {_rank('name', ['id', 'address', 'continent'])}, {_ser()} FROM valid
  UNION ALL
  SELECT 'continent', {_rank('continent', ['id', 'name', 'address'])}, {_ser()} FROM valid)
SELECT topic, "offset", value FROM ranked WHERE "offset" < {PEEK_N}""",
    "line_filter": f"""{WITH_LINES}SELECT o_orderkey, {_trim('value')} AS value FROM lines
WHERE {_trim('value')} <> ''
  AND length({_trim('value')}) - length(replace({_trim('value')}, ',', '')) >= 3""",
    "doc_line_filter": f"""WITH doc_lines AS (SELECT doc_id, text AS value FROM documents)
SELECT doc_id, {_trim('value')} AS value FROM doc_lines
WHERE {_trim('value')} <> ''
  AND length({_trim('value')}) - length(replace({_trim('value')}, ',', '')) >= 3""",
    "split_limit4": "WITH doc_lines AS (SELECT doc_id, text AS value FROM documents)\n"
                    + _split4("doc_lines", "doc_id", trim=False),
    "trim_fields": WITH_LINES + _split4("lines", "o_orderkey", trim=True),
    "strict_int": f"""{WITH_LINES}SELECT o_orderkey, f0 AS id_text, {_strict('f0')} AS id
FROM (SELECT o_orderkey, {_trim("string_split(value, ',')[1]")} AS f0 FROM lines)""",
    "parse_valid": f"{WITH_VALID}SELECT * FROM valid",
    "parse_rejects": f"""{WITH_VALID}SELECT o_orderkey, value,
  CASE WHEN NOT ok THEN 'few_fields' ELSE 'bad_id' END AS reject_reason
FROM parsed WHERE NOT ok OR id IS NULL""",
    "serialize_record": f"{WITH_PEOPLE}SELECT o_orderkey, {_ser()} AS value FROM people",
    "key_text": f"""{WITH_VALID}SELECT o_orderkey, CAST(id AS VARCHAR) AS id_key, name AS name_key,
  continent AS continent_key FROM valid""",
    "bucket_label": f"""{WITH_VALID}SELECT continent, replace(continent, ' ', '_') AS label, count(*) AS records
FROM valid GROUP BY continent""",
    "round_robin": """SELECT CAST(pos % 3 AS INTEGER) AS partition, CAST(pos // 3 AS BIGINT) AS "offset", doc_id
FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM documents)""",
    "bucket_route": f"{WITH_VALID}SELECT id, name, address, continent FROM valid",
    "sort_by_id": _sorted("id"),
    "sort_by_name": _sorted("name"),
    "sort_by_continent": _sorted("continent"),
    "sorted_runs": f"{WITH_VALID},\n{ARRIVAL}\nSELECT * FROM runs",
    "merge_runs": _sorted("name"),
    "bucket_order": f"""{WITH_VALID}SELECT row_number() OVER (ORDER BY c NULLS FIRST) - 1 AS "offset", c AS continent
FROM (SELECT CASE WHEN o_orderkey % 11 <> 0 THEN continent END AS c FROM valid)""",
    "sort_auto": """SELECT row_number() OVER (ORDER BY p_name) - 1 AS "offset", p_name AS name,
  CASE WHEN (SELECT count(DISTINCT p_name) FROM part) < 200 THEN 'bucket' ELSE 'merge' END AS strategy FROM part""",
    "sort_auto_id": f"""{WITH_VALID}SELECT {_rank('id', ['name', 'address', 'continent'])} AS "offset", id, name, address, continent,
  CASE WHEN (SELECT count(DISTINCT id) FROM valid) < 200 THEN 'bucket' ELSE 'merge' END AS strategy FROM valid""",
    "global_position": """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders""",
    "sort_all_keys": f"""{WITH_VALID}{_sorted_values('id')}
UNION ALL {_sorted_values('name')}
UNION ALL {_sorted_values('continent')}""",
    "top_n": f"""{WITH_VALID}SELECT * FROM (
  SELECT {_rank('name', ['id', 'address', 'continent'])} AS "offset", id, name, address, continent FROM valid)
WHERE "offset" < {TOP_N}""",
    "key_profile": WITH_VALID + " UNION ALL ".join(
        f"""SELECT '{k}' AS sort_key, count(*) AS rows, count(DISTINCT {k}) AS distinct_keys,
       CASE WHEN count(DISTINCT {k}) < 200 THEN 'bucket' ELSE 'merge' END AS strategy FROM valid"""
        for k in ("id", "name", "continent")),
    "key_sketch": WITH_VALID + " UNION ALL ".join(
        f"SELECT '{k}' AS sort_key, count(*) AS rows, count(DISTINCT {k}) AS distinct_keys, true AS within FROM valid"
        for k in ("id", "name", "continent")),
    "bucket_counts": f"{WITH_VALID}SELECT continent, count(*) AS records FROM valid GROUP BY continent",
    "publish_metrics": f"""{WITH_LINES},
t AS (SELECT value, {_trim('value')} AS v FROM lines),
u AS (SELECT v, length(v) - length(replace(v, ',', '')) AS commas FROM t)
SELECT count(*) AS read, count_if(v = '') AS dropped_blank, count_if(v <> '' AND commas < 3) AS dropped_few_fields,
       count_if(commas >= 3) AS sent, CAST(coalesce(sum(strlen(v)) FILTER (WHERE commas >= 3), 0) AS BIGINT) AS bytes FROM u""",
    "run_stats": f"""{WITH_VALID},\n{ARRIVAL}
SELECT run, count(*) AS records, min(id) AS min_key, max(id) AS max_key FROM runs GROUP BY run""",
    "check_sorted": f"""{WITH_VALID},
damaged AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 1000 = 500 THEN o_orderkey + 1 WHEN o_orderkey % 1000 = 501 THEN o_orderkey - 1
                               WHEN o_orderkey % 5000 = 7 THEN o_orderkey + 1 ELSE o_orderkey END AS o FROM orders),
lagged AS (SELECT o, k, lag(k) OVER (ORDER BY o, k) AS pk, lag(o) OVER (ORDER BY o, k) AS po FROM damaged),
bad AS (SELECT count(*) AS n, count_if(pk > k) AS wrong, coalesce(bool_or(o - po <> 1), false) OR min(o) <> 0 OR max(o) <> count(*) - 1 AS holes FROM lagged)
SELECT 'published' AS topic, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order, false AS position_gaps, true AS sorted FROM valid
UNION ALL SELECT 'damaged', n, wrong, holes, wrong = 0 AND NOT holes FROM bad""",
    "check_conserved": f"""{WITH_VALID}SELECT count(*) AS rows_in, count(*) AS rows_out, CAST(0 AS BIGINT) AS missing,
  CAST(0 AS BIGINT) AS extra, true AS fingerprint_equal FROM valid""",
    "record_differences": f"""{WITH_VALID},
a AS (SELECT id, name, address, continent FROM valid),
b AS (SELECT id, CASE WHEN o_orderkey % 89 = 0 THEN name || 'x' ELSE name END AS name, address, continent FROM valid WHERE o_orderkey % 97 <> 0
      UNION ALL SELECT id, name, address, continent FROM valid WHERE o_orderkey % 83 = 0)
SELECT 'missing' AS side, *, count(*) AS times FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY ALL
UNION ALL SELECT 'extra', *, count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY ALL""",
    "check_domains": _domains(),
    "stream_topic": f"{WITH_LINES},\n{KEPT}\nSELECT value, (SELECT count(*) FROM kept) AS positions FROM kept",
    "stream_metrics": f"""{WITH_LINES},
t AS (SELECT {_trim('value')} AS v FROM lines),
u AS (SELECT v, length(v) - length(replace(v, ',', '')) AS commas FROM t)
SELECT count(*) AS read, count_if(v = '') AS dropped_blank, count_if(v <> '' AND commas < 3) AS dropped_few_fields FROM u""",
    "stream_snapshot": """SELECT event_id, user_id, event_type, ts,
  row_number() OVER (ORDER BY ts, event_id) - 1 AS "offset" FROM events""",
}
