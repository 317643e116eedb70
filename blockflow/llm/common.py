"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockflow.runtime import ship

T = TypeVar("T")

#: Words are runs of anything but these six characters. ``bytes.split()`` cuts at exactly the same ones.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Most bytes of text that an Arrow operator handles at once; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20


def remainder(n: int, key: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo n; null for a null id."""
    return F.crc32(F.col(key).cast("string")) % n


def held_out(n: int, r: int, key: str = "doc_id") -> Column:
    """Whether the id's remainder is r. A null id is never held out."""
    return F.coalesce(remainder(n, key) == r, F.lit(False))


def text_column(df: DataFrame, name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(df[name].cast("string"), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added where a column of ``df`` has one (in any case of letters)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def own(df: DataFrame) -> list[Column]:
    """All columns of ``df`` by name."""
    return [F.col(f"`{c}`") for c in df.columns]


def map_blocks(df: DataFrame, fn: Callable[[dict[str, list]], dict], schema: str, text: str = "text", setup: Callable[[], object] | None = None, most: int = BLOCK_BYTES) -> DataFrame:
    """Apply ``fn`` to blocks of rows of at most ``most`` bytes of ``text``.

    ``fn`` gets the columns as lists (and ``setup()``'s result, if there is one) and returns columns of the
    same block, or None. Rows reach Python in Arrow batches and are sliced by bytes, so that the memory of a
    task doesn't depend on how long the texts of a batch are together.
    """
    ship(df.sparkSession)
    names = df.columns
    target = pa.schema([pa.field(f.name, _arrow(f.dataType)) for f in _schema(df, schema)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for batch in batches:
            for lo, hi in _cuts(batch.column(names.index(text)), most):
                part = batch.slice(lo, hi - lo)
                columns = {n: part.column(i).to_pylist() for i, n in enumerate(names)}
                out = fn(columns, state) if setup else fn(columns)
                if out is not None:
                    yield pa.RecordBatch.from_arrays([_cast(out[f.name], f.type) for f in target], schema=target)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def _cast(values: object, kind: pa.DataType) -> pa.Array:
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)


def _cuts(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes each (a longer row is alone)."""
    if column.nbytes <= most:
        if len(column):
            yield 0, len(column)
        return
    lengths = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    lo, total = 0, 0
    for i, n in enumerate(lengths):
        if i > lo and total + n > most:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(lengths):
        yield lo, len(lengths)


def _schema(df: DataFrame, ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl)


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def sql_words(text: Column) -> Column:
    """The words of a text as an array, without leaving the JVM."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


_held: dict[object, object] = {}


def held(key: object, make: Callable[[], T]) -> T:
    """The process's one large object, made anew if another was held: a worker that serves several stages keeps one cache."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]  # type: ignore[return-value]

