"""Schemas that drift between files: one consistent table, and a report of every change per file.

1. The header of a file is what its readable records carry: each key's share of the records and the kinds of
   its values, aggregated in parallel per (file, key). A key belongs to a file when at least half of its readable
   records carry it, null or not; its type is that of most of its non-null values.
2. Types are folded through the lattice boolean, whole < decimal < string: of kinds equally frequent the
   wider wins; each file's schema is folded into that of the files before it of its feed, in order, and each
   difference is logged with the type the field had, has, and is promoted to (``differences``). ``union_schema`` is
   the fold over all files.
3. Keys outside the contract are recognised as renamed contract fields: by a name equal but for case and
   separators, or by the name's words, the kind and size of values, and by never standing beside the field
   they rename (the more files, the stronger). Nothing of this is fixed to a list of known renames: words weigh by
   how few contract fields hold them. A name that shares no word with its field needs the evidence of many files.
4. All records are cast to the contract; fields outside it are kept, as text, in one column.

Unreadable payloads (null, broken, no JSON object) belong to no header and no table row; ``unreadable`` counts
them per file. A key of another kind of value or a missing key in single records changes nothing in the header
and gives null where it cannot be cast. Repeated lines count as they are. A field whose values in a file are
all null has no type there and is never retyped. Records without a file are left out of headers.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.functions.columns import feed_of
from tripmart.functions.names import plain, similarity, weights

KINDS = ["boolean", "whole number", "decimal number", "string", "nested"]
_HV, _B, _YN, _DT = r"(?i)^\s*HV-?[0-9]{4}\s*$", r"(?i)^\s*B[0-9]{5}\s*$", r"(?i)^\s*[YN]\s*$", r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:"
_CLASSES = ["hv", "b", "yn", "dt", "num", "bool", "text"]


def parsed(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """The raw lines with ``record``, a variant that is null where the payload is no JSON object."""
    opens = F.substring(F.ltrim(F.col(payload), F.lit(" \t\r\n")), 1, 1) == "{"
    return raw.withColumn("record", F.when(opens, F.try_parse_json(F.col(payload))))


def unreadable(raw: DataFrame, file: str = "source_file") -> DataFrame:
    return parsed(raw).groupBy(file).agg(F.count(F.lit(1)).alias("lines"), F.count_if(F.col("record").isNull()).alias("unreadable_lines"))


def _values(records: DataFrame) -> DataFrame:
    """``records`` with ``values``, an array of (pair, form): keys with their values as text, and the form of each value; null without a record.

    The forms are those the schema of the record lists, in the order of the keys. Records with nested values or odd
    keys, whose schema doesn't split at commas, are looked at value by value. Each step is a projection of its own, so
    nothing is computed twice.
    """
    read_ = records.withColumns(
        {"__pairs": F.map_entries(F.col("record").cast("map<string,string>")), "__schema": F.substring(F.schema_of_variant("record"), 8, 2**30)}
    )
    cut = read_.withColumn(
        "__forms",
        F.when(~(F.col("__schema").contains("<") | F.col("__schema").contains("`")), F.split(F.rtrim("__schema", F.lit(">")), ", "))
    )
    quick = F.arrays_zip(F.col("__pairs").alias("pair"), F.col("__forms").alias("form"))
    slow = F.transform(
        F.map_entries(F.col("record").cast("map<string,variant>")), lambda e: F.struct(
            F.struct(e["key"].alias("key"), F.try_variant_get(e["value"], "$", "string").alias("value")).alias("pair"),
            F.coalesce(F.schema_of_variant(e["value"]), F.lit("VOID")).alias("form")
        )
    )
    return cut.withColumn("values", F.when(F.size("__pairs") == F.size("__forms"), quick).otherwise(slow))


def headers(raw: DataFrame, file: str = "source_file", month: str = "data_month") -> DataFrame:
    """One row per (file, key) that belongs to the file: ``type``, shares, and what its values look like."""
    records = _values(parsed(raw).where(F.col(file).isNotNull()).select(F.col(file).alias("file"), F.col(month).alias("month"), "record"))
    # each record gives one row more, under a null key, so records are counted in the same aggregation
    own = F.array(
        F.struct(F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value")).alias("pair"), F.lit("VOID").alias("form"))
    )
    rows = records.select("file", "month", F.inline(F.when(F.col("record").isNotNull(), F.concat(own, "values"))))
    form = F.substring_index("form", ": ", -1)
    kind = F.when(form == "VOID", -1).when(form == "STRING", 3).when(form == "BIGINT", 1).when(
        form.startswith("DECIMAL") | form.isin("DOUBLE", "FLOAT"), 2
    ).when(form == "BOOLEAN", 0).otherwise(4)
    values = rows.select("file", "month", F.col("pair.key").alias("key"), kind.alias("kind"), F.when(kind < 4, F.col("pair.value")).alias("text"))
    text, kind = F.col("text"), F.col("kind")
    start = F.upper(F.ltrim(text))
    dated = F.substring(text, 5, 1) == "-"
    # what can't be a number isn't read as one: each failure costs an exception
    number = F.when(
        F.instr(F.lit("0123456789.-+$"), F.substring(start, 1, 1)).between(1, 14) & ~dated & (F.length(text) < 40),
        F.translate(text, "$ ,", "").try_cast("double")
    )
    looks = {
        "hv": start.startswith("HV") & text.rlike(_HV), "b": start.startswith("B") & text.rlike(_B), "yn": (F.length(text) < 9) & text.rlike(_YN),
        "dt": dated & (F.length(text) > 13) & text.rlike(_DT), "num": number.isNotNull(), "bool": F.lower(text).isin("true", "false"),
    }
    grouped = values.groupBy("file", "key").agg(
        F.min("month").alias("month"), F.count(F.lit(1)).alias("present"), F.count_if(kind >= 0).alias("filled"),
        *[F.count_if(kind == i).alias(f"k{i}") for i in range(len(KINDS))], *[F.count_if(c).alias(f"c_{n}") for n, c in looks.items()],
        F.sum(F.abs(number)).alias("size"),
    )
    most = F.array_max(F.array(*[F.struct(F.col(f"k{i}").alias("n"), F.lit(i).alias("i")) for i in range(len(KINDS))]))
    type_ = F.when(F.col("filled") > 0, F.element_at(F.array(*map(F.lit, KINDS)), most["i"] + 1))
    # a file's keys are as many as its records have, so its group in this window is small
    records_of = F.max(F.when(F.col("key").isNull(), F.col("present"))).over(Window.partitionBy("file"))
    own = grouped.withColumn("records", records_of).where(F.col("key").isNotNull() & (F.col("present") * 2 >= F.col("records")))
    return own.select("file", "month", "key", type_.alias("type"), "present", "records", "filled", *[f"c_{n}" for n in looks], "size")


@F.pandas_udf(T.StringType())
def _plain(a: pd.Series) -> pd.Series:
    return a.map(plain)


def _character(header: DataFrame, as_: str) -> DataFrame:
    """What the values of a key look like over all files: its main class and mean size."""
    total = header.groupBy(F.col("key").alias(as_)).agg(
        F.count(F.lit(1)).alias(f"{as_}_files"), F.sum("filled").alias("filled"), *[F.sum(f"c_{c}").alias(f"c_{c}") for c in _CLASSES[:-1]],
        F.sum("size").alias("size")
    )
    main = F.coalesce(*[F.when(F.col(f"c_{c}") * 2 > F.col("filled"), F.lit(c)) for c in _CLASSES[:-1]], F.when(F.col("filled") > 0, F.lit("text")))
    return total.select(as_, f"{as_}_files", main.alias(f"{as_}_class"), F.try_divide(F.col("size"), F.col("c_num")).alias(f"{as_}_size"))


def _name_similarity(fields: Sequence[str]):
    telling = weights(fields)

    @F.pandas_udf(T.DoubleType())
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        memo: dict[tuple[str, str], float] = {}
        return pd.Series([memo[p] if p in memo else memo.setdefault(p, similarity(*p, telling)) for p in zip(a, b)], dtype="float64")

    return alike


def aliases(header: DataFrame, fields: Sequence[str], *, least_name: float = 0.5, least_evidence: float = 4.0, least_score: float = 0.75) -> DataFrame:
    """``key, field``: keys outside the contract that are contract fields under another name.

    ``least_evidence`` is the power of ten against the chance that a key would stand only in files that lack
    the field, were it another field's; it stands in for a name that tells nothing.
    """
    names = F.array(*map(F.lit, fields))
    files = header.select("file").distinct().count()
    there = header.where(F.col("key").isin(list(fields))).groupBy("file").agg(F.collect_set("key").alias("there"))
    unknown = header.where(~F.col("key").isin(list(fields))).select("file", "key").join(there, "file", "left")
    pairs = unknown.select("key", "there", F.explode(names).alias("field")).groupBy("key", "field").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.array_contains("there", F.col("field"))).alias("beside")
    )
    known = _character(header.where(F.col("key").isin(list(fields))), "field")
    pairs = pairs.join(_character(header, "key"), "key").join(known, "field", "left").withColumn("name", _name_similarity(fields)("key", "field"))
    absent = F.greatest(F.lit(0.02), 1 - F.coalesce("field_files", F.lit(0)) / F.lit(max(files, 1)))
    evidence = -F.col("n") * F.log10(absent)
    # a flag may be written as true and false, a time as seconds or milliseconds since 1970
    other_form = ((F.col("key_class") == "bool") & (F.col("field_class") == "yn")) | (
        (F.col("key_class") == "num") & (F.col("field_class") == "dt") & (F.col("key_size") > 1e8)
    )
    same_class = other_form | F.col("key_class").isNull() | F.col("field_class").isNull() | (F.col("key_class") == F.col("field_class"))
    ratio = F.abs(F.log10(F.greatest(F.col("key_size"), F.lit(1e-3)) / F.greatest(F.col("field_size"), F.lit(1e-3))))
    fits = F.when(F.col("key_size").isNull() | F.col("field_size").isNull(), F.lit(0.5)).otherwise(F.greatest(F.lit(0.0), 1 - ratio))
    score = F.col("name") + F.least(F.lit(1.0), evidence / (2 * least_evidence)) * 0.5 + fits * 0.3
    seldom = F.col("beside") * 50 <= F.col("n")
    accepted = (F.col("name") == 1.0) | (
        same_class & seldom & ((F.col("name") >= least_name) | ((evidence >= least_evidence) & (F.col("name") > 0) & (fits >= 0.5))) & (score >= least_score)
    ) | (same_class & F.col("key_class").isNotNull() & seldom & (evidence >= 2 * least_evidence) & (fits >= 0.5))
    best = pairs.where(accepted).groupBy("key").agg(F.max_by("field", F.struct(score.alias("s"), F.col("field"))).alias("field"))
    return best


def resolved(header: DataFrame, alias: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Headers with ``field``, the identity of a key across files, and ``field_name``, its name in reports.

    Of several keys of a file that are one field, its own name wins, then the key in most records.
    """
    named = header.join(alias, "key", "left").withColumn("contract", F.when(F.col("key").isin(list(fields)), F.col("key")).otherwise(F.col("field")))
    named = named.withColumns({"field": F.coalesce("contract", F.concat(F.lit("~"), _plain("key"))), "field_name": F.coalesce("contract", "key")})
    order = Window.partitionBy("file", "field").orderBy((F.col("key") == F.col("field")).desc(), F.col("present").desc(), "key")
    return named.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place", "contract")


def _promoted(kinds: Column) -> Column:
    """The least type of the lattice that holds all of the kinds; null where there is none."""
    rank = F.array_max(F.transform(kinds, lambda k: F.array_position(F.array(*map(F.lit, KINDS)), k)))
    mixed = F.array_contains(kinds, "boolean") & (F.size(kinds) > 1)
    return F.when(F.size(kinds) == 0, F.lit(None)).when(mixed, F.lit("string")).otherwise(F.element_at(F.array(*map(F.lit, KINDS)), rank.cast("int")))


def differences(fields: DataFrame) -> DataFrame:
    """The log: ``source_file, feed, sequence, field_name, change_kind, type_before, type_now, promoted_to`` of every file against the previous one of its feed."""
    order = Window.partitionBy("feed", "field").orderBy("month", "file").rowsBetween(Window.unboundedPreceding, 0)
    folded = fields.withColumn("feed", feed_of(F.col("file"))).withColumn("promoted", _promoted(F.collect_set("type").over(order)))
    per_file = folded.groupBy("feed", "file").agg(
        F.min("month").alias("month"),
        F.map_from_entries(F.collect_list(F.struct("field", F.struct("key", "type", "field_name", "promoted")))).alias("now")
    )
    place = Window.partitionBy("feed").orderBy("month", "file")
    both = per_file.withColumns({"before": F.lag("now").over(place), "sequence": F.row_number().over(place)}).where(F.col("before").isNotNull())
    each = both.select("file", "feed", "sequence", F.explode(F.array_union(F.map_keys("now"), F.map_keys("before"))).alias("field"), "now", "before")
    n, b = F.col("now")[F.col("field")], F.col("before")[F.col("field")]
    kinds = F.array(
        F.when(b.isNull(), F.lit("added")), F.when(n.isNull(), F.lit("removed")),
        F.when(n["key"] != b["key"], F.lit("renamed")), F.when(n["type"] != b["type"], F.lit("retyped")),
    )
    return each.select(
        F.col("file").alias("source_file"), "feed", "sequence", F.coalesce(
            n["field_name"], b["field_name"]
        ).alias("field_name"), F.explode(F.array_compact(kinds)).alias("change_kind"),
        b["type"].alias("type_before"), n["type"].alias("type_now"), F.coalesce(n["promoted"], b["promoted"]).alias("promoted_to"),
    )


def changes(fields: DataFrame) -> DataFrame:
    return differences(fields).select("source_file", "field_name", "change_kind")


def union_schema(fields: DataFrame) -> DataFrame:
    """Each field over all files: the least type of the lattice that holds its types, and the files it is in."""
    folded = fields.groupBy("field_name").agg(
        F.collect_set("type").alias("kinds"), F.countDistinct("file").alias("files"), F.min("month").alias("first_month"),
        F.max("month").alias("last_month")
    )
    return folded.select("field_name", _promoted(F.col("kinds")).alias("type"), "files", "first_month", "last_month")


def hundredths(header: DataFrame, alias: DataFrame, decimals: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """``source_file, in_hundredths``: decimal fields that a file writes as whole numbers of a hundred times the size."""
    named = resolved(header, alias, fields).where(F.col("field").isin(list(decimals)) & (F.col("c_num") > 0))
    usual = named.where("type = 'decimal number'").groupBy("field").agg((F.sum("size") / F.sum("c_num")).alias("usual"))
    whole = named.where("type = 'whole number'").join(usual, "field").where(F.col("size") > F.col("c_num") * F.col("usual") * 20)
    return whole.groupBy(F.col("file").alias("source_file")).agg(F.collect_set("field").alias("in_hundredths"))


def consistent_table(
    raw: DataFrame, header: DataFrame, alias: DataFrame, contract: Sequence[tuple[str, str]],
    keep: Sequence[str] = ("record_id", "source_file", "data_month", "line_no")
) -> DataFrame:
    """Every readable record in the contract's columns and types; a value that can't be cast is null.

    ``other_fields`` holds what stands outside the contract, as JSON of texts, null where there is nothing.
    Keys are translated record by record, so a record that doesn't follow its file is read as well. Values
    are brought to the contract's form: currency signs go, seconds or milliseconds since 1970 become times,
    true and false become Y and N, hundredths of a decimal are divided.
    """
    per_field = alias.groupBy("field").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    other_keys = per_field.agg(F.map_from_entries(F.collect_list(F.struct("field", "keys"))).alias("other_keys")).scalar()
    names = [n for n, _ in contract]
    scales = hundredths(header, alias, [n for n, t in contract if t == "double"], names)
    rows = parsed(raw).where(F.col("record").isNotNull()).select(
        *keep, F.col("record").cast("map<string,string>").alias("r"), other_keys.alias("other_keys")
    ).join(scales, "source_file", "left")

    def value(name: str, kind: str) -> Column:
        others = F.coalesce(F.col("other_keys")[name], F.array().cast("array<string>"))
        held = F.filter(F.transform(others, lambda k: F.col("r")[k]), lambda x: x.isNotNull())
        text = F.coalesce(F.col("r")[name], F.get(held, F.lit(0)))
        if kind in ("int", "bigint"):
            return text.try_cast("double").try_cast(kind)
        if kind == "double":
            number = F.regexp_replace(text, "[$ ,]", "").try_cast("double")
            return F.when(F.coalesce(F.array_contains("in_hundredths", name), F.lit(False)) & ~text.contains("."), number / 100).otherwise(number)
        if kind.startswith("timestamp"):
            seconds = F.when(text.rlike("^[0-9]{9,11}$"), text.try_cast("bigint")).when(
                text.rlike("^[0-9]{12,14}$"), (text.try_cast("double") / 1000).try_cast("bigint")
            )
            return F.coalesce(F.timestamp_seconds(seconds).cast(kind), F.when(~text.rlike("^[0-9]+$"), text.try_cast(kind)))
        return F.when(F.lower(text) == "true", F.lit("Y")).when(F.lower(text) == "false", F.lit("N")).otherwise(text)

    taken = F.concat(F.array(*map(F.lit, names)), F.flatten(F.map_values("other_keys")))
    others = F.map_filter("r", lambda k, v: ~F.array_contains(taken, k))
    return rows.select(*keep, *[value(n, t).alias(n) for n, t in contract], F.when(F.size(others) > 0, F.to_json(others)).alias("other_fields"))
