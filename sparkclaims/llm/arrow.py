"""Reading Arrow batches of documents in slices of bounded bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of each batch with the bytes of their texts (null: empty).

    A part holds at most ``most`` bytes of text, or one text if it is longer.
    """
    for batch in batches:
        column = pc.fill_null(batch.column(batch.schema.get_field_index(text)).cast(pa.binary()), b"")
        sizes = pc.binary_length(column).to_pylist()
        begin = size = 0
        for at, length in enumerate(sizes):
            if at > begin and size + length > most:
                yield batch.slice(begin, at - begin), column.slice(begin, at - begin).to_pylist()
                begin, size = at, 0
            size += length
        if begin < len(sizes):
            yield batch.slice(begin), column.slice(begin).to_pylist()
