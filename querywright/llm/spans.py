"""Pattern matches with their places, and small expression helpers, in SQL functions only."""

from pyspark.sql import Column
from pyspark.sql import functions as F


CHUNK = 128               # matches that are placed one after the other


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def found(text: Column, pattern: str, start: Column | None = None) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value), in code points, end exclusive.

    The text is split at the matches; the lengths of the stretches between them and of the matches add up to the places.
    The matches of one text bound the array."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
    zipped = F.filter(F.arrays_zip(gaps.alias("gap"), values.alias("value")), lambda z: z["value"].isNotNull())
    none = F.expr("CAST(array() AS array<struct<start: int, end: int, value: string>>)")
    size = lambda z: z["gap"] + F.char_length(z["value"])

    def placed(chunk: Column, at: Column) -> Column:
        return F.aggregate(chunk, F.struct(at.alias("at"), none.alias("out")), lambda acc, z: F.struct(
            (acc["at"] + size(z)).alias("at"), F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + z["gap"]).alias("start"), (acc["at"] + size(z)).alias("end"), z["value"].alias("value")))).alias("out")),
            lambda acc: acc["out"])

    # an array that grows match by match is copied each time: places are summed in chunks, chunks from where they begin
    def chunked(all_: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / CHUNK).cast("int")),
                           lambda i: F.slice(all_, i * CHUNK + 1, F.lit(CHUNK)))

    def begun(chunks: Column) -> Column:
        return F.aggregate(chunks, F.array(F.lit(0)), lambda acc, c: F.concat(acc, F.array(
            F.element_at(acc, -1) + F.aggregate(c, F.lit(0), lambda n, z: n + size(z)))))

    def whole(chunks: Column) -> Column:
        return let(begun(chunks), lambda at: F.flatten(F.transform(chunks, lambda c, i: placed(c, F.get(at, i)))))

    return F.when(text.rlike(pattern), let(zipped, lambda z: F.when(F.size(z) <= CHUNK, placed(z, F.lit(0))).otherwise(
        let(chunked(z), whole)))).otherwise(none)
