"""Positions of regular-expression matches with SQL functions only.

``split`` gives what lies between the matches and ``regexp_extract_all`` the matches; the running sum of their
lengths in code points gives the offsets. Everything stays inside the row.
"""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def running(sizes: Column) -> Column:
    """Sums of the elements before each one, by blocks so that long arrays do not cost their square."""
    blocks = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(sizes) / BLOCK).cast("int") - 1, F.lit(0)))

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, b: a + b)

    def inside(x: Column) -> Column:
        sums = F.transform(blocks, lambda b: total(F.slice(x, b * BLOCK + 1, F.lit(BLOCK))))
        starts = let(sums, lambda s: F.transform(blocks, lambda b: total(F.slice(s, F.lit(1), b))))
        return let(
            starts,
            lambda s: F.transform(
                x,
                lambda _, i: F.get(s, F.floor(i / BLOCK).cast("int"))
                + total(F.slice(x, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)),
            ),
        )

    return let(sizes, inside)


def matches(text: Column, pattern: str, group: int = 0, context: int = 0) -> Column:
    """Array of (start, end, value) of the leftmost non-overlapping matches, in code points.

    ``value`` is the match or one group of it. With ``context``, ``before`` and ``after`` follow: so many
    characters at most, up to the neighbouring match. The pattern must not match an empty string. A null
    text has no matches.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    sizes = F.transform(gaps, lambda g: F.char_length(g)).alias("gap")
    columns = [sizes, F.transform(whole, lambda m: F.char_length(m)).alias("size"), part.alias("value")]
    if context:
        columns.append(F.transform(gaps, lambda g: F.substring(g, -context, context)).alias("tail"))
        columns.append(F.transform(F.slice(gaps, F.lit(2), F.size(gaps)), lambda g: F.substring(g, 1, context)).alias("head"))
    # The last gap has no match after it.
    pairs = F.filter(F.arrays_zip(*columns), lambda z: z["size"].isNotNull())

    def span(z: Column, before: Column) -> Column:
        fields = [(before + z["gap"]).alias("start"), (before + z["gap"] + z["size"]).alias("end"), z["value"].alias("value")]
        return F.struct(*fields, *([z["tail"].alias("before"), z["head"].alias("after")] if context else []))

    found = let(
        pairs,
        lambda p: let(
            running(F.transform(p, lambda z: z["gap"] + z["size"])),
            lambda before: F.transform(p, lambda z, i: span(z, F.get(before, i))),
        ),
    )
    kind = "array<struct<start:int,end:int,value:string" + (",before:string,after:string>>" if context else ">>")
    return F.when(text.rlike(pattern), found).otherwise(F.array()).cast(kind)


def labelled(found: Column, kind: str, order: int) -> Column:
    """The spans of one kind as (start, end, kind, order)."""
    return F.transform(
        found,
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), F.lit(order).alias("order")),
    )


def listed(spans: Column, by_start: bool) -> Column:
    """``kind:start:end`` joined by commas, by start and kind or by kind and start."""
    keys = ("start", "order") if by_start else ("order", "start")
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(*[s[k] for k in (*keys, "end", "kind")])))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def outside(found: Column, taken: Column) -> Column:
    """The spans that overlap none of ``taken``."""
    return F.filter(
        found, lambda f: ~F.exists(taken, lambda t: (t["start"] < f["end"]) & (f["start"] < t["end"]))
    )
