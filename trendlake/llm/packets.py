"""Parallel arrays that travel between tasks as one row of bytes per bucket.

Postings of a few bytes each would cost far more as rows; a packet holds all that a
task has gathered for a bucket.
"""

from __future__ import annotations

#: Elements that a task gathers before it hands them on.
FLUSH = 500_000


class Packer:
    """Gathers parallel arrays and hands them on as one row of bytes per bucket."""

    def __init__(self, names: list[str]):
        self.names, self.parts, self.size = names, [], 0

    def add(self, bucket, *columns) -> None:
        self.parts.append((bucket, *columns))
        self.size += len(bucket)

    def flush(self):
        import numpy as np
        import pyarrow as pa

        if not self.size:  # nothing, or empty arrays only
            self.parts = []
            return
        bucket, *columns = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.size = [], 0
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        ends = np.r_[cuts[1:], len(bucket)]
        arrays = [pa.array(bucket[cuts].astype(np.int64))]
        for c in columns:
            c = c[order]
            arrays.append(pa.array([c[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()))
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", *self.names])


def unpacked(batches, dtypes):
    """All rows of a partition: the bucket of every element, and its columns."""
    import numpy as np

    buckets, columns = [], [[] for _ in dtypes]
    for batch in batches:
        for i, b in enumerate(batch.column(0).to_pylist()):
            parts = [np.frombuffer(batch.column(j + 1)[i].as_py(), d) for j, d in enumerate(dtypes)]
            buckets.append(np.full(len(parts[0]), b, np.int64))
            for c, p in zip(columns, parts):
                c.append(p)
    if not buckets:
        return None
    return np.concatenate(buckets), *[np.concatenate(c) for c in columns]
