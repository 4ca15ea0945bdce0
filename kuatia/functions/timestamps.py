"""Publication times written in many forms, brought to one UTC instant (problem 3).

Every text gets an array of all its valid interpretations; each is a format and
an instant. Formats are patterns that rewrite a text to its parts in one order,
so that one expression turns the parts into an instant. Texts of several
interpretations are decided by Viterbi over their source's record order
(``choose``): a path pays for each change of format and for each jump back in time.

Fixed rules: figures have the year first or the day first; a text without a zone
is wall-clock time of the given zone; a wall-clock time that occurs twice means
the first; one that a change skipped is read with the offset before the change; a
zone abbreviation means what ZONES says. The readings that a rule ranks second
(the other occurrence, the offset behind the change, the abbreviation's other
meaning) are states of the path too; each costs RULE, more than all that a few
hours can save at both its neighbours, so that the rules hold by the path's cost.
Results by case: null, blank and relative texts, dates without a time of day and
impossible dates have no interpretation and give null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOME_ZONE = "America/Asuncion"
#: Years that a number of seconds may stand for.
EPOCH_YEARS = (1971, 2100)

# Month names by their first letters, and zone abbreviations with their offsets.
MONTHS = {
    "ene": 1, "jan": 1, "feb": 2, "fev": 2, "mar": 3, "abr": 4, "apr": 4, "may": 5, "mai": 5, "jun": 6, "jul": 7,
    "ago": 8, "aug": 8, "sep": 9, "set": 9, "oct": 10, "out": 10, "nov": 11, "dic": 12, "dec": 12, "dez": 12,
}
ZONES = {
    "z": "+00:00", "ut": "+00:00", "utc": "+00:00", "gmt": "+00:00", "est": "-05:00", "edt": "-04:00", "cst": "-06:00", "cdt": "-05:00",
    "mst": "-07:00", "mdt": "-06:00", "pst": "-08:00", "pdt": "-07:00", "pyt": "-04:00", "pyst": "-03:00", "art": "-03:00", "brt": "-03:00",
    "cet": "+01:00", "cest": "+02:00", "wet": "+00:00", "west": "+01:00", "bst": "+01:00", "clt": "-04:00", "clst": "-03:00", "uyt": "-03:00",
}
#: Second meanings of zone abbreviations.
OTHER_ZONES = {"cst": "+08:00", "bst": "+06:00", "pyt": "-03:00"}
#: Fixed value: the zone whose offset has been constant since this wall-clock time; older zone tables lack the change.
FIXED_SINCE = {"America/Asuncion": ("2024-10-06 01:00:00", "-03:00")}

_LETTERS = "a-záéíóúüñçãõêâô"
_MONTH = rf"(?:[{_LETTERS}]{{3,}})"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_HALF = r"(?:\s*([ap])\.?\s*m(?![a-z])\.?)?"
_HOURS = r"(?:\s*(?:hs?|hrs?|horas?)(?![a-z])\.?)?"
_ZONE = r"(?:\s*\[?((?:z|[a-z]{2,5}|(?:utc|gmt)?\s?[+-]\d{1,2}(?::?\d{2})?|[a-z]+/[a-z_]+(?:/[a-z_]+)?))\]?)?(?:\s*[\[(][a-z_/ ]+[\])])?"
_GAP = r"(?:\s*(?:t|,|-|–|\||·|a las?|às)\s*|\s+)"
#: name: (pattern, where year, month, day, hour, minute, second, fraction, half and zone are among its groups).
FORMATS = {
    "year-first": (rf"^(?:[^0-9+-]*\s)?(\d{{4}})([-/.])(\d{{1,2}})\2(\d{{1,2}}){_GAP}{_TIME}{_HALF}{_HOURS}{_ZONE}$", (1, 3, 4, 5, 6, 7, 8, 9, 10)),
    "day-first": (rf"^(?:[^0-9+-]*\s)?(\d{{1,2}})([-/.])(\d{{1,2}})\2(\d{{4}}){_GAP}{_TIME}{_HALF}{_HOURS}{_ZONE}$", (4, 3, 1, 5, 6, 7, 8, 9, 10)),
    "day-first-short": (rf"^(?:[^0-9+-]*\s)?(\d{{1,2}})([-/.])(\d{{1,2}})\2(\d{{2}}){_GAP}{_TIME}{_HALF}{_HOURS}{_ZONE}$", ("20$4", 3, 1, 5, 6, 7, 8, 9, 10)),
    "year-first-short": (rf"^(?:[^0-9+-]*\s)?(\d{{2}})([-/.])(\d{{1,2}})\2(\d{{1,2}}){_GAP}{_TIME}{_HALF}{_HOURS}{_ZONE}$", ("20$1", 3, 4, 5, 6, 7, 8, 9, 10)),
    "basic": (rf"^(\d{{4}})(\d{{2}})(\d{{2}})[t ]?(\d{{2}}):?(\d{{2}})(?::?(\d{{2}})(?:[.,](\d{{1,9}}))?)?{_ZONE}$", (1, 2, 3, 4, 5, 6, 7, None, 8)),
    "day-month": (rf"^(?:[^0-9+-]*\s)?(\d{{1,2}})(?:º|°)?[\s-]*(?:de\s+)?({_MONTH})\.?,?[\s-]*(?:del?\s+)?(\d{{4}}){_GAP}{_TIME}{_HALF}{_HOURS}{_ZONE}$", (3, 2, 1, 4, 5, 6, 7, 8, 9)),
    "month-day": (rf"^(?:.*\s)?({_MONTH})\.?\s+(\d{{1,2}})(?:º|°|st|nd|rd|th)?,?\s+(\d{{4}}){_GAP}{_TIME}{_HALF}{_HOURS}{_ZONE}$", (3, 1, 2, 4, 5, 6, 7, 8, 9)),
    "time-date": (rf"^(?:[^0-9+-]*\s)?{_TIME}{_HALF}{_HOURS}(?:\s*[-–,|·]\s*|\s+)(?:del?\s+)?(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}})$", (8, 7, 6, 1, 2, 3, 4, 5, None)),
    "ctime": (rf"^(?:[{_LETTERS}]+,?\s+)?({_MONTH})\s+(\d{{1,2}})\s+{_TIME}{_ZONE}\s+(\d{{4}})$", (8, 1, 2, 3, 4, 5, 6, None, 7)),
}
INTERPRETATION = "struct<format:string,utc_us:bigint>"


def plain(text: Column) -> Column:
    """Lower case, ordinary digits and spaces, no invisible characters, no white space at the ends."""
    wide = "".join(chr(0xFF01 + i) for i in range(94))
    text = F.translate(text, wide, "".join(chr(0x21 + i) for i in range(94)))
    text = F.regexp_replace(text, "[\\u00AD\\u200B-\\u200F\\u2060\\uFEFF\\u202A-\\u202E]", "")
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(text, "[\\s\\p{Z}]+", " "), "[\\u2212\\u2010\\u2011]", "-")))


def _rewritten(text: Column, name: str) -> Column:
    pattern, places = FORMATS[name]
    to = "|".join("" if p is None else p if isinstance(p, str) else f"${p}" for p in places)
    return F.when(text.rlike(pattern), F.concat(F.lit(name + "|"), F.regexp_replace(text, pattern, to)))


def _lookup(values: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def _instants(read: Column, zone: str, every: bool) -> Column:
    """ARRAY<STRUCT<format, utc_us>> of an array of [format, year, month, day, hour, minute, second, fraction, half, zone]; utc_us is null if there is no such time.

    every: also the readings that a fixed rule ranks second, their format marked
    with SECOND. Each step binds its values once, for the next to use several times.
    """
    named = [zone, "America/Asuncion", "Europe/Madrid", "America/New_York", "America/Sao_Paulo", "America/Buenos_Aires", "America/Argentina/Buenos_Aires", "Europe/London", "Europe/Paris", "Europe/Berlin", "Europe/Lisbon", "Europe/Rome", "America/Santiago", "America/Montevideo", "America/La_Paz", "America/Bogota", "America/Lima", "America/Mexico_City", "America/Chicago", "America/Denver", "America/Los_Angeles", "America/Caracas", "Asia/Tokyo", "Asia/Taipei", "Etc/UTC"]
    utc = F.lit("UTC")

    def values(parts: Column) -> Column:
        month = F.coalesce(parts[2].try_cast("int"), F.try_element_at(_lookup(MONTHS), F.translate(F.substring(parts[2], 1, 3), "áéíóúç", "aeiouc")))
        second = F.coalesce(parts[6].try_cast("int"), F.lit(0))
        micros = F.substring(F.rpad(parts[7], 6, "0"), 1, 6).try_cast("int")
        written = parts[9]
        offset = F.regexp_replace(written, "^(?:utc|gmt)?\\s?([+-]\\d.*)$", "$1")
        region = F.array_join(F.transform(F.split(F.initcap(F.regexp_replace(written, "[/_]", "$0 ")), "(?<=[/_]) "), lambda x: x), "")
        return F.struct(
            parts[0].alias("format"), parts[1].try_cast("int").alias("year"), month.alias("month"), parts[3].try_cast("int").alias("day"),
            parts[4].try_cast("int").alias("hour"), parts[8].alias("half"), parts[5].try_cast("int").alias("minute"),
            F.when(second < 60, (second + micros / F.lit(1000000).cast("decimal(10,0)")).cast("decimal(16,6)")).alias("seconds"), written.alias("written"),
            F.when(written.rlike("\\d"), offset).alias("offset"), F.when(written.contains("/"), region).when(written == "", F.lit(zone)).alias("region"),
        )

    def placed(x: Column) -> Column:
        hour = F.when(x["half"] == "", x["hour"]).when((x["hour"] < 1) | (x["hour"] > 12), None).when(x["half"] == "p", x["hour"] % 12 + 12).otherwise(x["hour"] % 12)
        offset = x["offset"]
        offset = F.when(offset.rlike("^[+-]\\d{1,2}$"), F.concat(F.substring(offset, 1, 1), F.lpad(F.substring(offset, 2, 2), 2, "0"), F.lit(":00"))).otherwise(F.regexp_replace(F.regexp_replace(offset, "^([+-])(\\d)(:?\\d{2})$", "$10$2$3"), "^([+-]\\d{2})(\\d{2})$", "$1:$2"))
        return F.struct(x["format"].alias("format"), x["written"].alias("written"), F.when(x["region"].isin(named), x["region"]).alias("region"), offset.alias("offset"), F.try_make_timestamp(x["year"], x["month"], x["day"], hour, x["minute"], x["seconds"], utc).alias("wall"))

    def zoned(x: Column) -> Column:
        fixed = F.when(x["offset"].rlike("^[+-](?:0\\d|1[0-4]):[0-5]\\d$"), x["offset"]).otherwise(F.try_element_at(_lookup(ZONES), x["written"]))
        for name, (since, constant) in FIXED_SINCE.items():
            fixed = F.when((x["region"] == name) & (x["wall"] >= F.lit(since).cast("timestamp")), F.lit(constant)).otherwise(fixed)
        return F.struct(x["format"].alias("format"), x["written"].alias("written"), x["wall"].alias("wall"), fixed.alias("fixed"), F.coalesce(fixed, x["region"]).alias("zone"))

    def exact(x: Column) -> Column:
        # a wall-clock time that occurs twice is the first, one that was skipped has the offset before
        return F.struct(x["format"].alias("format"), x["written"].alias("written"), x["wall"].alias("wall"), x["fixed"].alias("fixed"), F.to_utc_timestamp(x["wall"], x["zone"]).alias("at"))

    steps = F.transform(F.transform(F.transform(read, values), placed), zoned)
    steps = F.transform(steps, exact)

    def one(x: Column) -> Column:
        return F.struct(x["format"].alias("format"), F.unix_micros(x["at"]).alias("utc_us"))

    if not every:
        return F.transform(steps, one)
    hour = F.expr("interval 1 hour")

    def second(x: Column) -> Column:
        # by the zone's clock an hour on: the same figures again (they occur twice), or not those written (they were skipped)
        local, again = F.from_utc_timestamp(x["at"], F.lit(zone)), F.from_utc_timestamp(x["at"] + hour, F.lit(zone))
        clock = F.when(again == local, x["at"] + hour).when(local == x["wall"] + hour, x["at"] - hour)
        meant = F.try_element_at(_lookup(OTHER_ZONES), x["written"])
        other = F.when((x["written"] == "") & x["fixed"].isNull(), clock).when(meant.isNotNull(), F.to_utc_timestamp(x["wall"], meant))
        return F.struct(F.concat(x["format"], F.lit(SECOND)).alias("format"), F.unix_micros(other).alias("utc_us"))

    return F.flatten(F.transform(steps, lambda x: F.array(one(x), second(x))))


def interpretations(text: Column, zone: str = HOME_ZONE, every: bool = False) -> Column:
    """ARRAY<STRUCT<format, utc_us>> of the text's valid interpretations, distinct in their instants; empty for none, also for null.

    every: with the readings that the fixed rules rank second.
    """
    t = plain(text)
    low, high = EPOCH_YEARS
    span = [int((y - 1970) * 365.2425 * 86400) for y in (low, high)]
    epochs = [F.when(t.rlike(r"^-?\d{9,19}(?:\.\d{1,6})?$"), t.try_cast("decimal(28,6)") * F.lit(10**p).cast("decimal(10,0)")) for p in (6, 3, 0)]
    epochs.append(F.when(t.rlike(r"^\d{18,19}$"), t.try_cast("decimal(28,6)") / F.lit(1000).cast("decimal(10,0)")))
    numbers = F.array(*(F.struct(F.lit(f"epoch-{n}").alias("format"), e.try_cast("long").alias("utc_us")) for n, e in zip(("s", "ms", "us", "ns"), epochs)))
    numbers = F.filter(numbers, lambda x: x["utc_us"].between(span[0] * 10**6, span[1] * 10**6))
    written = F.filter(F.array(*(_rewritten(t, name) for name in FORMATS)), lambda x: x.isNotNull())
    read = _instants(F.transform(written, lambda x: F.split(x, "\\|", -1)), zone, every)
    all_ = F.when(t.rlike(r"^-?\d{9,19}(?:\.\d{1,6})?$"), numbers).when(t.rlike(r"\d{1,2}:?\d{2}"), F.filter(read, lambda x: x["utc_us"].isNotNull())).otherwise(F.array().cast(f"array<{INTERPRETATION}>"))
    # bound by an array of one, else it would be taken anew for each element
    distinct = F.transform(F.array(all_), lambda every_one: F.filter(every_one, lambda x, i: ~F.exists(F.slice(every_one, 1, F.greatest(i, F.lit(0))), lambda y: y["utc_us"] == x["utc_us"])))[0]
    return F.coalesce(distinct, F.array().cast(f"array<{INTERPRETATION}>"))


#: What a path pays for a change of format, and for a jump back in time: a fixed part and a part by its length in days.
SWITCH, BACK, BACK_PER_DAY = 1.0, 0.5, 0.1
#: What a reading costs that a fixed rule ranks second, and how its format is marked.
RULE, SECOND = 8.0, "/second"


def _own(state: tuple[str, int]) -> float:
    return RULE if state[0].endswith(SECOND) else 0.0


def _cost(a: tuple[str, int], b: tuple[str, int]) -> float:
    back = (a[1] - b[1]) / 86_400_000_000
    return SWITCH * (a[0].removesuffix(SECOND) != b[0].removesuffix(SECOND)) + (BACK + BACK_PER_DAY * back if back > 0 else 0.0) + _own(b)


def viterbi(states: list[list[tuple[str, int]]]) -> list[int]:
    """The cheapest choice of one state a step; among equals the smallest index, latest step first."""
    best, back = [_own(state) for state in states[0]], []
    for before, now in zip(states, states[1:]):
        costs = [[best[i] + _cost(a, b) for i, a in enumerate(before)] for b in now]
        back.append([c.index(min(c)) for c in costs])
        best = [min(c) for c in costs]
    path = [best.index(min(best))]
    for row in reversed(back):
        path.append(row[path[-1]])
    return path[::-1]


def choose(df: DataFrame, source: str, order: list[str], candidates: str, out: str) -> DataFrame:
    """df with ``out BIGINT``: the instant chosen among each row's candidates (null where there are none).

    A row of one candidate splits its source's chain: what comes before it and
    what follows are decided independently. So only runs of rows with several
    candidates, between two decided rows, go through Viterbi, each run in one
    group; rows without candidates do not take part. The position in the record
    order is found by counting decided rows over a range-partitioned sort, so no
    task holds a whole source.
    """
    several = df.where(F.size(candidates) > 1)
    simple = df.where(F.size(candidates) <= 1).withColumn(out, F.try_element_at(candidates, F.lit(1))["utc_us"])
    if not several.take(1):
        return simple
    keys = [F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"), F.struct(*order).alias("_order")]
    rows = df.where(F.size(candidates) > 0).select(*keys, F.col(candidates).alias("_c")).distinct()
    runs = _runs(rows)
    schema = T.StructType([*rows.schema.fields, T.StructField("_chosen", T.LongType())])

    def decide(run):
        run = run.sort_values("_at", kind="stable")
        states = [[(c["format"], c["utc_us"]) for c in cs] for cs in run["_c"]]
        run["_chosen"] = [s[i][1] for s, i in zip(states, viterbi(states))]
        run = run[[len(s) > 1 for s in states]]
        return run[["_source", "_order", "_c", "_chosen"]]

    chosen = runs.groupBy("_source", "_run").applyInPandas(decide, schema)
    marked = several.select(*keys, F.col(candidates).alias("_c"), "*")
    joined = marked.join(chosen.withColumnsRenamed({"_source": "_s2", "_order": "_o2", "_c": "_c2"}), F.col("_source").eqNullSafe(F.col("_s2")) & F.col("_order").eqNullSafe(F.col("_o2")) & F.col("_c").eqNullSafe(F.col("_c2")), "left")
    return simple.unionByName(joined.select(*df.columns, F.col("_chosen").alias(out)))


def _runs(rows: DataFrame) -> DataFrame:
    """Rows of the undecided runs, with the decided row at either end; ``_run`` numbers the runs and ``_at`` orders a run.

    The rows are sorted by (source, order) over a range partitioning and numbered in
    that order; the number of decided rows up to a row names its run, from sums by
    partition, of which there are few.
    """
    from kuatia.session import stage

    ordered = stage(rows.withColumn("_one", F.size("_c") == 1).repartitionByRange("_source", "_order").sortWithinPartitions("_source", "_order", F.to_json("_c")).withColumn("_id", F.monotonically_increasing_id()), "record-order")
    parts = ordered.groupBy(F.shiftright("_id", 33).alias("_part")).agg(F.sum(F.col("_one").cast("long")).alias("_n"))  # one row a partition
    before = parts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    part = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = ordered.withColumn("_part", F.shiftright("_id", 33)).join(F.broadcast(before), "_part").withColumn("_k", F.col("_before") + F.sum(F.col("_one").cast("long")).over(part))
    # a decided row ends the run before it and begins its own
    begins = numbered.select("_source", "_order", "_c", "_one", F.col("_k").alias("_run"), F.col("_id").alias("_at"))
    ends = numbered.where("_one").select("_source", "_order", "_c", "_one", (F.col("_k") - 1).alias("_run"), F.col("_id").alias("_at"))
    every = begins.unionByName(ends)
    live = every.where(~F.col("_one")).select("_run", "_source").distinct()
    return every.join(live, ["_run", "_source"], "left_semi")


def instants(df: DataFrame, text: str, source: str, order: list[str], out: str, zone: str = HOME_ZONE) -> DataFrame:
    """df with ``out BIGINT``: each text's instant in microseconds since 1970-01-01 UTC, null where it gives none."""
    if out in df.columns:
        raise ValueError(f"column exists already: {out}")
    from kuatia.session import stage

    # read each text once, whether or not any has several interpretations; pass narrow rows
    with_all = stage(df.withColumn("_interpretations", interpretations(F.col(text), zone, every=True)), "interpretations")
    return choose(with_all, source, order, "_interpretations", out).drop("_interpretations")
