"""Texts that cross the network compressed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import free


def press(docs: DataFrame, names: list[str], text: str, version: str = "__version") -> tuple[DataFrame, str]:
    """names, the text's hash as ``version`` and the text compressed (null stays null), and the name of that last column."""
    held = free([*names, version, text], "_pressed")
    carried = list(dict.fromkeys([*names, version, text]))

    def run(batches):
        import pyarrow as pa
        import zstandard

        pressed = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            z = [None if t is None else pressed.compress(t.encode()) for t in batch.column(carried.index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(carried.index(c)) for c in (*names, version)), pa.array(z, pa.binary())], [*names, version, held])

    source = docs.withColumn(version, F.xxhash64(text)).select(*carried)
    schema = ", ".join([*(f"`{c}` {t}" for c, t in source.select(*names).dtypes), f"`{version}` long, `{held}` binary"])
    return source.mapInArrow(run, schema), held


def unpress(column) -> list[bytes | None]:
    """UTF-8 of an Arrow column of compressed texts."""
    import zstandard

    out = zstandard.ZstdDecompressor()
    return [None if z is None else out.decompress(z) for z in column.to_pylist()]
