"""What the operators share on the Spark side."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import new_folder, scratch, shared_folder
from ..session import stage as materialize

__all__ = ["add_columns", "apart", "fresh", "map_batches", "materialize", "named", "new_folder", "parts", "scratch", "shared_folder", "sorted_groups", "tidied"]


def tidied(fn):
    """fn, a function of Arrow batches; at its end the worker gives memory it no longer needs back to the machine.

    Workers live on between tasks, several on each executor, and would otherwise
    keep what their largest batch took.
    """

    def run(batches):
        yield from fn(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return run


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch."""

    def run(batches):
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(tidied(run), schema)


def parts(batch: pa.RecordBatch, column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of a batch's rows that hold about `most` bytes of a column, one row at least; it bounds what is turned into Python objects at once."""
    cells = batch.column(column)
    lengths = pc.fill_null(pc.multiply(pc.list_value_length(cells), 4) if pa.types.is_list(cells.type) else pc.binary_length(cells), 0).to_numpy(zero_copy_only=False)
    first = held = 0
    for k, n in enumerate(lengths.tolist()):
        if held and held + n > most:
            yield batch.slice(first, k - first)
            first, held = k, 0
        held += n
    if first < batch.num_rows:
        yield batch.slice(first)


def sorted_groups(df: DataFrame, keys: list[str], order: list[str], fn, schema: str, least: int = 4000, heavy: bool = False) -> DataFrame:
    """Runs fn on pyarrow tables of whole groups, in key order.

    Rows are shuffled by the keys and sorted; each call gets at least `least`
    rows (fewer at the end), cut where a group ends.  So many small groups cost
    one call, and a group is never split.  heavy: fn takes long for its bytes, so
    adaptive execution, which goes by bytes, is kept from putting partitions together.
    """

    def run(batches):
        held: list[pa.RecordBatch] = []
        rows = 0
        for whole in batches:
            for start in range(0, whole.num_rows, least):
                batch = whole.slice(start, least)
                held.append(batch)
                rows += batch.num_rows
                if rows < least:
                    continue
                table = pa.Table.from_batches(held).combine_chunks()
                cut = table.num_rows - 1
                last = [table.column(k)[cut].as_py() for k in keys]
                columns = [table.column(k) for k in keys]
                low, high = 0, cut  # the first row of the last group, by bisection
                while low < high:
                    mid = (low + high) // 2
                    if [c[mid].as_py() for c in columns] == last:
                        high = mid
                    else:
                        low = mid + 1
                if low:
                    yield from fn(table.slice(0, low))
                rest = table.slice(low)
                held, rows = rest.to_batches(), rest.num_rows
        if rows:
            yield from fn(pa.Table.from_batches(held).combine_chunks())

    dealt = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys) if heavy else df.repartition(*keys)
    return dealt.sortWithinPartitions(*keys, *order).mapInArrow(tidied(run), schema)


def named(df: DataFrame, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Rows that have a key, and those that have none."""
    return df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Each name, with as many underscores before it as make it none of df's columns (upper case or not)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def apart(key: str) -> Column:
    """A long key as an expression that is not known to be the column it came from.

    An aggregate by a key leaves its rows dealt by it, and a join on the same
    column takes them as they lie; the other side's frequent keys then can't be
    split.  A join on this expression shuffles both sides, so they can.
    """
    return F.col(key).bitwiseXOR(F.lit(0).cast("long"))


def add_columns(df: DataFrame, fn, inputs: list[str], outputs: str, replaced: str | None = None) -> DataFrame:
    """df with further columns, or one replaced, from a function of Arrow arrays.

    fn gets the input columns of a batch and returns the output arrays.  Outputs
    are named as a schema says; with `replaced`, the first takes that column's place.
    All other columns go through as they are.
    """
    names = df.columns
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    at = [names.index(c) for c in inputs]
    hole = names.index(replaced) if replaced else None
    added = [o.split()[0].strip("`") for o in outputs.split(", ") if o]

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            new = list(fn(*(columns[i] for i in at)))
            if hole is not None:
                columns[hole] = new.pop(0)
            yield pa.RecordBatch.from_arrays([*columns, *new], names=[*names, *added])

    plain = df.toDF(*(f"c{k}" for k in range(len(names))))  # mapInArrow takes no names with dots
    return plain.mapInArrow(tidied(run), ", ".join([*fields, *([outputs] if outputs else [])]))
