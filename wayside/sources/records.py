"""Records of CSV files whose quoted fields may hold line breaks, read by many tasks a file.

A line of text does not say whether it begins inside a quoted field; that depends on all
lines before it. But for either case it says whether the next line does, and such answers
can be put together: each task finds, for its split of a file, where a reader that begins
it outside or inside of quotes ends up. Put together in the order of the splits, this gives
the state at the start of every split. In a second pass each task joins its lines to
records; only the pieces of records that cross the ends of splits, at most two of a split,
are shuffled and joined.

A quote opens a field only where the field begins; within it a doubled quote is a quote.
Lines end with a line feed; a carriage return before it is no part of the last field.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: How a piece of a record lies in its split: all of it, begun but not ended there, neither,
#: or only ended.
WHOLE, BEGUN, WITHIN, ENDED = range(4)


def text_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """(value, file, start): the lines of all files with the start of their split."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header): the first line of every file that has one.

    Found by the tasks that read the files' first splits; the driver opens no file.
    """
    first = text_lines(spark, path).where(F.col("start") == 0).withColumn("at", F.monotonically_increasing_id())
    return first.groupBy("file").agg(F.min_by("value", "at").alias("header"))


def _tools() -> tuple[Callable, Callable]:
    """What tasks run, self-contained, so that workers need not import this package."""
    whole, begun, within, ended = WHOLE, BEGUN, WITHIN, ENDED
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    quoted = r'"(?:[^"]|"")*"(?:[^",][^,]*)?'
    field = rf'(?:{quoted}|(?:[^",][^,]*)?)'
    opened = r'"(?:[^"]|"")*$'
    from_outside = rf"^(?:{field},)*{opened}"
    from_inside = rf'^(?:[^"]|"")*$|^(?:[^"]|"")*"(?:[^",][^,]*)?,(?:{field},)*{opened}'

    def ends(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Whether the next line begins inside quotes, if this one begins outside, or inside."""
        some = pc.match_substring(values, '"')
        out = np.zeros(len(values), bool), np.ones(len(values), bool)
        at = np.flatnonzero(some.to_numpy(zero_copy_only=False))
        if len(at):
            odd = values.take(pa.array(at))
            for found, pattern in zip(out, (from_outside, from_inside), strict=True):
                found[at] = pc.match_substring_regex(odd, pattern).to_numpy(zero_copy_only=False)
        return out

    def states(outside: np.ndarray, inside: np.ndarray, state: bool) -> np.ndarray:
        """The state at the start of each line and after the last one."""
        fixed, flips = outside == inside, np.cumsum(outside & ~inside)
        last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
        base = np.where(last >= 0, outside[last], state)
        since = flips - np.where(last >= 0, flips[last], 0)
        return np.concatenate([[state], base ^ (since % 2 == 1)])

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        """Row ranges of one split."""
        split = batch.column("split").to_numpy()
        cuts = [0, *(np.flatnonzero(split[1:] != split[:-1]) + 1).tolist(), len(split)]
        return zip(cuts[:-1], cuts[1:], strict=True)

    def split_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(file, start, split, outside, inside): the states after a split."""
        held, now = None, [False, True]

        def row() -> pa.RecordBatch:
            cells = [*held, *now]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
            arrays = [pa.array([c], k) for c, k in zip(cells, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["file", "start", "split", "outside", "inside"])

        for batch in batches:
            for i, j in runs(batch) if len(batch) else ():
                one = batch.slice(i, 1)
                key = tuple(one.column(c)[0].as_py() for c in ("file", "start", "split"))
                if key != held:
                    if held:
                        yield row()
                    held, now = key, [False, True]
                both = ends(batch.column("value").slice(i, j - i))
                now = [bool(states(*both, s)[-1]) for s in now]
        if held:
            yield row()

    def records(batches: Iterator[pa.RecordBatch], splits: np.ndarray, begin: np.ndarray) -> Iterator[pa.RecordBatch]:
        """(file, start, piece, first, record); the state at the start of each split is given."""
        held, state, lines, piece, first = None, False, [], whole, False

        def out(texts: list | pa.Array, piece: int, first: bool) -> pa.RecordBatch:
            n = len(texts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([held[0]] * n, pa.string()),
                    pa.array(np.full(n, held[1]), pa.int64()),
                    pa.array(np.full(n, piece), pa.int8()),
                    pa.array(np.arange(n) == (0 if first else -1)),
                    pa.array(texts, pa.string()) if isinstance(texts, list) else texts.cast(pa.string()),
                ],
                names=["file", "start", "piece", "first", "record"],
            )

        def close() -> Iterator[pa.RecordBatch]:
            """What is left of a split."""
            if lines:
                open_end = {whole: begun, within: within}[piece]
                yield out(["\n".join(lines)], open_end if state else {whole: whole, within: ended}[piece], first)

        for batch in batches:
            for i, j in runs(batch) if len(batch) else ():
                one = batch.slice(i, 1)
                key = tuple(one.column(c)[0].as_py() for c in ("file", "start", "split"))
                if key != held:
                    if held:
                        yield from close()
                    at = np.searchsorted(splits, key[2])
                    if at == len(splits) or splits[at] != key[2]:
                        raise ValueError("files are split otherwise than when they were read; read them again")
                    held, state, lines = key, bool(begin[at]), []
                    piece, first = within if state else whole, key[1] == 0
                values = batch.column("value").slice(i, j - i)
                found = states(*ends(values), state)
                starts, state = np.flatnonzero(~found[:-1]), bool(found[-1])
                if not len(starts):
                    lines += values.to_pylist()
                    continue
                lines += values.slice(0, starts[0]).to_pylist()
                if lines:
                    yield out(["\n".join(lines)], piece if piece == whole else ended, first)
                    first = False
                piece = whole
                length = np.diff(starts)
                single = starts[:-1][length == 1]
                if first and len(starts) > 1:
                    # the file's first record comes first, whatever its length
                    yield out(["\n".join(values.slice(starts[0], length[0]).to_pylist())], whole, True)
                    first, single = False, single[single != starts[0]]
                    starts, length = starts[1:], length[1:]
                if len(single):
                    yield out(values.take(pa.array(single)), whole, False)
                several = np.flatnonzero(length > 1)
                if len(several):
                    texts = ["\n".join(values.slice(starts[k], length[k]).to_pylist()) for k in several.tolist()]
                    yield out(texts, whole, False)
                lines = values.slice(starts[-1]).to_pylist()
        if held:
            yield from close()

    return split_ends, records


def _begin(lines: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all splits, ascending, and whether each begins inside quotes."""
    split_ends, _ = _tools()
    found = lines.mapInArrow(split_ends, "file string, start long, split long, outside boolean, inside boolean")
    order = F.array_sort(F.collect_list(F.struct("start", "split", "outside", "inside")))
    state = "struct<state:boolean,done:array<struct<split:bigint,begin:boolean>>>"

    def step(done, x):
        begin = F.struct(x["split"].alias("split"), done["state"].alias("begin"))
        after = F.when(done["state"], x["inside"]).otherwise(x["outside"])
        return F.struct(after.alias("state"), F.concat(done["done"], F.array(begin)).alias("done"))

    start = F.struct(F.lit(False).alias("state"), F.array().alias("done")).cast(state)
    splits = found.groupBy("file").agg(F.aggregate(order, start, step)["done"].alias("splits"))
    # a number and a flag for each split, of which the driver plans the tasks anyway
    rows = splits.select(F.inline("splits")).orderBy("split").collect()
    return np.array([r.split for r in rows], np.int64), np.array([r.begin for r in rows], bool)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record): every record of the files but their headers, as text."""
    lines = text_lines(spark, path, "\n").withColumn("split", F.xxhash64("file", "start"))
    splits, begin = _begin(lines)
    _, records = _tools()
    cut = lines.mapInArrow(
        lambda batches: records(batches, splits, begin), "file string, start long, piece byte, first boolean, record string"
    )
    whole = cut.where(F.col("piece") == WHOLE).select("file", "first", "record")
    # a piece that begins a record comes last in its split
    pieces = cut.where(F.col("piece") != WHOLE).withColumn("last", F.col("piece") == BEGUN)
    upto = Window.partitionBy("file").orderBy("start", "last").rowsBetween(Window.unboundedPreceding, 0)
    number = F.sum(F.col("last").cast("int")).over(upto)
    text = F.array_sort(F.collect_list(F.struct("start", "last", "record")))
    joined = (
        pieces.withColumn("number", number)
        .groupBy("file", "number")
        .agg(F.max("first").alias("first"), F.array_join(F.transform(text, lambda p: p["record"]), "\n").alias("record"))
        .select("file", "first", "record")
    )
    out = whole.union(joined).where(~F.col("first"))
    return out.select("file", F.regexp_replace("record", "\r$", "").alias("record")).where(F.col("record") != "")
