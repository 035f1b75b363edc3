"""Building blocks of the checking SQL (DuckDB dialect) over the `events` table."""

from __future__ import annotations

from yieldline import schemas

BOOKINGS = """bookings AS (
  SELECT CAST(event_id AS VARCHAR) AS booking_id,
         'SN' || CAST(event_id // 16 AS VARCHAR) AS serial_number,
         '100' || CAST(1 + event_id % 8 AS VARCHAR) AS station_number,
         CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END AS book_state,
         ts AS date_created,
         'P' || CAST((event_id // 16) % 4 AS VARCHAR) AS part_number,
         CAST(value AS DECIMAL(10,2)) AS cycle_time,
         CAST(1 + (event_id // 8) % 2 AS INTEGER) AS test_count,
         event_type, user_id, props
  FROM events)"""

FACT_COLUMNS = ", ".join(schemas.STATION_RECORDS.names)

IDEAL = (
    "ideal AS (SELECT station_number, CAST(ideal_cycle_time AS DECIMAL(10,2)) AS ideal_cycle_time"
    f" FROM {schemas.values_sql(schemas.IDEAL_CYCLE_TIME_ROWS, schemas.IDEAL_CYCLE_TIMES.names)})"
)
STATIONS = f"stations AS (SELECT * FROM {schemas.values_sql(schemas.STATION_ROWS, schemas.STATIONS.names)})"


def with_(*parts: str, select: str) -> str:
    """A WITH statement; bookings come first."""
    return "WITH " + ",\n".join((BOOKINGS, *parts)) + "\n" + select


def hour(column: str = "date_created", grain: str = "hour") -> str:
    return f"CAST(date_trunc('{grain}', {column}) AS TIMESTAMP)"


def cents(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(18,2)) * 100 AS HUGEINT)"


def rounded(numerator: str, denominator: str, scale: int = 2, precision: int = 18) -> str:
    """round(numerator / denominator, scale) for whole numbers that are not negative."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"NULLIF(CAST({denominator} AS HUGEINT), 0)"
    steps = f"({2 * 10**scale} * {n} + {d}) // (2 * {d})"
    unit = "0." + "0" * (scale - 1) + "1"
    return f"CAST(CAST({steps} AS DECIMAL(18,0)) * CAST('{unit}' AS DECIMAL({scale + 1},{scale})) AS DECIMAL({precision},{scale}))"


def percent(part: str, whole: str) -> str:
    return rounded(f"100 * ({part})", whole)


def performance(name: str, source: str = "bookings", ideal: str = "ideal", grain: str = "hour") -> str:
    """CTEs ending in `name`: the performance model."""
    return f"""{name}_base AS (
  SELECT station_number, {hour(grain=grain)} AS date_hour, part_number,
         SUM(cycle_time) AS total, COUNT(cycle_time) AS timed, COUNT(serial_number) AS n
  FROM {source} GROUP BY ALL),
{name} AS (
  SELECT b.station_number, b.date_hour, b.part_number,
         {rounded(cents("total"), "100 * timed", 2, 12)} AS avg_cycle_time,
         i.ideal_cycle_time, n AS count_bookings,
         {rounded(f"100 * {cents('i.ideal_cycle_time')} * n", cents("total"))} AS performance_percent
  FROM {name}_base b LEFT JOIN {ideal} i USING (station_number))"""


def availability(name: str, source: str = "bookings", grain: str = "hour") -> str:
    """The availability model from gaps between neighbours."""
    seconds = {"hour": 3600, "day": 86400}[grain]
    return f"""{name}_gaps AS (
  SELECT station_number, date_hour, epoch_us(date_created) - LAG(epoch_us(date_created))
           OVER (PARTITION BY station_number, date_hour ORDER BY date_created) AS gap
  FROM (SELECT *, {hour(grain=grain)} AS date_hour FROM {source})),
{name} AS (
  SELECT station_number, date_hour,
         {rounded("SUM(gap)", "1000000", 2, 12)} AS uptime_seconds,
         {rounded("SUM(gap)", str(seconds * 1_000_000), 4, 12)} AS availability
  FROM {name}_gaps GROUP BY station_number, date_hour)"""


def quality(name: str, source: str = "bookings", grain: str = "hour") -> str:
    """The quality model from a whole-history window and distinct counts."""
    return f"""{name}_rows AS (
  SELECT *, {hour(grain=grain)} AS date_hour,
         test_count = MAX(test_count) OVER (PARTITION BY station_number, serial_number) AS final
  FROM {source}),
{name} AS (
  SELECT station_number, part_number, date_hour,
         COUNT(serial_number) AS total_bookings,
         COUNT(serial_number) FILTER (book_state = 'FAIL') AS fail_bookings,
         COUNT(serial_number) FILTER (book_state = 'PASS') AS pass_bookings,
         COUNT(DISTINCT serial_number) FILTER (final) AS total_pcb,
         COUNT(DISTINCT serial_number) FILTER (final AND book_state = 'FAIL') AS fail_pcb,
         COUNT(DISTINCT serial_number) FILTER (final AND book_state = 'PASS') AS pass_pcb
  FROM {name}_rows GROUP BY station_number, part_number, date_hour)"""


def legacy_quality(name: str, source: str = "bookings", grain: str = "hour") -> str:
    """The older quality view from a running maximum."""
    return f"""{name}_rows AS (
  SELECT *, test_count = MAX(test_count) OVER (PARTITION BY station_number, serial_number, date_hour
           ORDER BY date_created RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS final
  FROM (SELECT *, {hour(grain=grain)} AS date_hour FROM {source})),
{name} AS (
  SELECT station_number, date_hour,
         COUNT(serial_number) AS total_bookings,
         COUNT(serial_number) FILTER (book_state = 'FAIL') AS fail_bookings,
         COUNT(serial_number) FILTER (book_state = 'PASS') AS pass_bookings,
         COUNT(DISTINCT serial_number) FILTER (final) AS total_pcb,
         COUNT(DISTINCT serial_number) FILTER (final AND book_state = 'FAIL') AS fail_pcb,
         COUNT(DISTINCT serial_number) FILTER (final AND book_state = 'PASS') AS pass_pcb
  FROM {name}_rows GROUP BY station_number, date_hour)"""


def first_pass(name: str, source: str = "bookings", grain: str = "hour", part: str = "part_number, ") -> str:
    return f"""{name}_boards AS (
  SELECT {part}serial_number, MAX(date_created) AS seen, COUNT(*) FILTER (book_state = 'FAIL') AS fails
  FROM {source} GROUP BY ALL),
{name} AS (
  SELECT {part}{hour("seen", grain)} AS date_hour, COUNT(*) FILTER (fails = 0) AS fpy_pcbs,
         COUNT(*) FILTER (fails > 0) AS reworked_pcbs, COUNT(*) AS total_pcbs
  FROM {name}_boards GROUP BY ALL)"""


def line_yield(name: str, quality_name: str, part: str = "part_number, ") -> str:
    scrap = ", ".join(f"'{s}'" for s in schemas.SCRAP_STATIONS)
    return f"""{name}_sums AS (
  SELECT {part}date_hour,
         CAST(SUM(pass_pcb) FILTER (station_number = '{schemas.FINAL_STATION}') AS BIGINT) AS good,
         CAST(SUM(fail_pcb) FILTER (station_number IN ({scrap})) AS BIGINT) AS bad
  FROM {quality_name} GROUP BY ALL),
{name} AS (
  SELECT {part}date_hour, good AS pass_pcb_linewise, bad AS scrap_pcb_linewise,
         good + bad AS total_pcb_linewise,
         {percent("good", "good + bad")} AS pass_pcb_linewise_percent,
         {percent("bad", "good + bad")} AS scrap_pcb_linewise_percent
  FROM {name}_sums)"""


def linewise(name: str, quality_name: str, source: str = "bookings", grain: str = "hour", by_part: bool = True) -> str:
    """The line model on top of a quality CTE."""
    part = "part_number, " if by_part else ""
    return f"""{first_pass(name + "_fp", source, grain, part)},
{line_yield(name + "_ly", quality_name, part)},
{name} AS (
  SELECT {part}date_hour, fpy_pcbs, {percent("fpy_pcbs", "total_pcb_linewise")} AS fpy_percent,
         pass_pcb_linewise, scrap_pcb_linewise, total_pcb_linewise,
         pass_pcb_linewise_percent, scrap_pcb_linewise_percent
  FROM {name}_fp JOIN {name}_ly USING ({part}date_hour))"""


def station_fact(name: str, grain: str = "hour") -> str:
    """Hourly fact per station out of the three models; needs bookings and ideal."""
    pcb = ", ".join(
        f"CAST(SUM({c}) AS BIGINT) AS {c}"
        for c in ("total_bookings", "fail_bookings", "pass_bookings", "total_pcb", "fail_pcb", "pass_pcb")
    )
    return f"""{performance(name + "_p", grain=grain)},
{availability(name + "_a", grain=grain)},
{quality(name + "_q", grain=grain)},
{name}_speed AS (
  SELECT station_number, date_hour, SUM(total) AS total, SUM(timed) AS timed, CAST(SUM(n) AS BIGINT) AS n
  FROM {name}_p_base GROUP BY ALL),
{name}_boards AS (SELECT station_number, date_hour, {pcb} FROM {name}_q GROUP BY ALL),
{name} AS (
  SELECT station_number, date_hour,
         {rounded(cents("total"), "100 * timed", 2, 12)} AS avg_cycle_time, ideal_cycle_time,
         n AS count_bookings,
         {rounded(f"100 * {cents('ideal_cycle_time')} * n", cents("total"))} AS performance_percent,
         uptime_seconds, availability,
         total_bookings, fail_bookings, pass_bookings, total_pcb, fail_pcb, pass_pcb
  FROM {name}_speed FULL JOIN {name}_a USING (station_number, date_hour)
       FULL JOIN {name}_boards USING (station_number, date_hour) LEFT JOIN ideal USING (station_number))"""


def oee(fact: str) -> str:
    product = (
        "CAST(availability * 10000 AS HUGEINT) * CAST(performance_percent * 100 AS HUGEINT) * pass_pcb"
    )
    return f"""SELECT station_number, date_hour, availability, performance_percent,
       {percent("pass_pcb", "total_pcb")} AS quality_percent,
       {rounded(product, "1000000 * total_pcb")} AS oee_percent
FROM {fact}"""
