"""Column functions over sequences, headers and prediction blocks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value evaluated once, however often `use` names it, also within lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


def once(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows, with `columns` evaluated before what follows.

    A filter goes below a projection with all expressions of it that it names, and these are evaluated there anew, as often as they are
    named; an array of one struct that is exploded stops it.
    """
    kept = [c for c in rows.columns if c not in columns]
    return rows.select(*kept, F.explode(F.array(F.struct(*columns))).alias("once")).select(*kept, *[F.col("once")[c].alias(c) for c in columns])


def header_token(header: Column, name: str) -> Column:
    """Value of a name=value token after the first; empty if there is none."""
    return F.regexp_extract(header, rf"\s{name}=(\S+)", 1)


def tagged_id(header: Column, tag: str, prefix: str) -> Column:
    """Identifier after `tag:` such as gene:ENSG0001 or gene:ENSG0001.2; empty if there is none."""
    return F.regexp_extract(header, rf"{tag}:({prefix}\w*\d(?:\.\d+)?)" if prefix else rf"{tag}:(\S+)", 1)


def _bytes_of(x: pa.Array, unit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all strings end to end, where each string begins and how many it has; unit: 1 for ASCII strings as they lie, 4 for code points."""
    if unit == 4:
        parts = [s.encode("utf-32-le", "surrogatepass") for s in x.to_pylist()]
        sizes = np.array([len(p) // 4 for p in parts], np.int64)
        return np.frombuffer(b"".join(parts), "<u4"), np.cumsum(sizes) - sizes, sizes
    whole = pa.concat_arrays([x.cast(pa.large_string())])
    _, offsets, data = whole.buffers()
    offsets = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets[:-1], np.diff(offsets)


def _equal_places(q: pa.Array, t: pa.Array, unit: int) -> list[int]:
    """Per pair the places of the shorter one at which both have the same character, a slice of either against one of the other."""
    (a, a_at, a_n), (b, b_at, b_n) = _bytes_of(q, unit), _bytes_of(t, unit)
    return [int(np.count_nonzero(a[i : i + n] == b[j : j + n])) for i, j, n in zip(a_at.tolist(), b_at.tolist(), np.minimum(a_n, b_n).tolist())]


@F.arrow_udf(IntegerType())
def _matches(q: pa.Array, t: pa.Array) -> pa.Array:
    """Equal characters at equal places: bytes of ASCII pairs, code points of others; 0 where either is empty, null where either is null."""
    known = pc.and_(pc.is_valid(q), pc.is_valid(t))
    ascii_ = pc.and_(pc.string_is_ascii(q), pc.string_is_ascii(t)).fill_null(False)
    out = np.zeros(len(q), np.int32)
    for unit, those in ((1, ascii_), (4, pc.and_not(known, ascii_))):
        at = np.flatnonzero(those.to_numpy(zero_copy_only=False))
        if len(at):
            out[at] = _equal_places(q.take(pa.array(at)), t.take(pa.array(at)), unit)
    return pa.array(out, pa.int32(), mask=~known.to_numpy(zero_copy_only=False))


def matches(q: Column, t: Column) -> Column:
    """Places at which both have the same character: by columns of bytes, as an array of one string a character is many times the sequence."""
    return _matches(q, t)


def _places_in(t: pa.Array, sign: str) -> pa.Array:
    """Per text the 1-based places of an ASCII character, in characters; none where the text is null."""
    known = t.fill_null("")
    unit = 1 if pc.all(pc.string_is_ascii(known), min_count=0).as_py() else 4
    data, begins, sizes = _bytes_of(known, unit)
    low, high = (int(begins[0]), int(begins[-1] + sizes[-1])) if len(t) else (0, 0)
    at = np.flatnonzero(data[low:high] == ord(sign)) + low
    own = np.searchsorted(begins, at, "right") - 1  # the last text that begins there, as empty ones before it do too
    ends = np.searchsorted(own, np.arange(len(t) + 1))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(at - begins[own] + 1, pa.int32()))


def places(t: Column, sign: str) -> Column:
    """1-based places of an ASCII character in a text: by columns of bytes, as matches()."""

    @F.arrow_udf(ArrayType(IntegerType()))
    def of(t: pa.Array) -> pa.Array:
        return _places_in(t, sign)

    return of(t)


def positional_identity(q: Column, t: Column) -> Column:
    """Equal characters at equal places over the shorter length; 0.0 if either is empty or missing."""
    return F.when((F.length(q) > 0) & (F.length(t) > 0), matches(q, t) / F.least(F.length(q), F.length(t))).otherwise(F.lit(0.0))


def report_identity(q: Column, t: Column) -> Column:
    """The same in percent of the query's length."""
    return F.when((F.length(q) > 0) & (F.length(t) > 0), matches(q, t) / F.length(q) * 100).otherwise(F.lit(0.0))


def first_mutation(t: Column) -> tuple[Column, Column]:
    """0-based place and kind (stop at X, shift at !) of the first mutation; nulls if there is none."""
    x, shift = F.nullif(F.instr(t, "X"), F.lit(0)), F.nullif(F.instr(t, "!"), F.lit(0))
    at = F.least(x, shift)
    return at - 1, F.when(at == x, "stop").when(at == shift, "shift")


def flank_identities(q: Column, t: Column, at: Column, flank: int = 30) -> tuple[Column, Column]:
    """Identity of up to `flank` characters before a 0-based place and after it; an empty side is 0.0."""
    start = F.greatest(at - flank, F.lit(0))
    before = positional_identity(F.substring(q, start + 1, at - start), F.substring(t, start + 1, at - start))
    after = positional_identity(F.substring(q, at + 2, F.lit(flank)), F.substring(t, at + 2, F.lit(flank)))
    return F.when(at > 0, before).otherwise(F.lit(0.0)), after


def query_id(text: Column) -> Column:
    """First `Query protein:` id of a block; empty if there is none."""
    return F.regexp_extract(text, r"Query protein:\s+(\S+)", 1)


def query_lines(text: Column) -> Column:
    """The lines of a block that begin with `Query protein:`."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: x.startswith("Query protein:")), "\n")


def count_of(text: Column, sign: str) -> Column:
    """How often an ASCII sign stands in a text: by the bytes that go with it."""
    return ((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(sign), F.lit("")))) / len(sign)).cast("long")


def stop_count(text: Column) -> Column:
    """Number of *, or of :X[ if there is no *."""
    return F.when(text.contains("*"), count_of(text, "*")).otherwise(count_of(text, ":X["))


def shift_count(text: Column) -> Column:
    """Number of !."""
    return count_of(text, "!")


def block_score(text: Column) -> Column:
    """First `Score ... bits` as a double; null if there is none."""
    return F.regexp_extract(text, r"Score\s+([0-9.]+)\s+bits", 1).try_cast("double")
