"""A stand-in for a remote service: pages of a Parquet table."""

from __future__ import annotations

from bisect import bisect_right
from functools import cache, lru_cache

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs


@cache
def _row_groups(path: str) -> tuple[list[int], list[tuple[str, int]], int]:
    """First row and place of every row group, in file order, and the number of rows."""
    system, root = fs.FileSystem.from_uri(path)
    files = [root]
    if system.get_file_info(root).type == fs.FileType.Directory:
        names = sorted(f.path for f in system.get_file_info(fs.FileSelector(root)))
        files = [n for n in names if n.endswith(".parquet")]
    starts, groups, total = [], [], 0
    for name in files:
        metadata = pq.read_metadata(name, filesystem=system)
        for number in range(metadata.num_row_groups):
            starts.append(total)
            groups.append((name, number))
            total += metadata.row_group(number).num_rows
    return starts, groups, total


@lru_cache(maxsize=1)
def _decoded(path: str, number: int) -> pa.Table:
    system, _ = fs.FileSystem.from_uri(path)
    name, group = _row_groups(path)[1][number]
    # No threads: this runs in a forked Python worker.
    return pq.ParquetFile(name, filesystem=system).read_row_group(group, use_threads=False)


class ParquetPages:
    """Serves the rows of a Parquet file or folder by offset.

    A process keeps the last row group it decoded, so that pages in a row share it.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def rows(self, offset: int, limit: int) -> list[dict]:
        starts, _, total = _row_groups(self.path)
        found, end = [], min(offset + limit, total)
        while offset < end:
            number = bisect_right(starts, offset) - 1
            part = _decoded(self.path, number).slice(offset - starts[number], end - offset)
            found.extend(part.to_pylist())
            offset += part.num_rows
        return found

    def counted(self, page: int, size: int) -> dict:
        total = _row_groups(self.path)[2]
        return {
            "rows": self.rows((page - 1) * size, size),
            "total_pages": -(-total // size),
            "total_record": total,
        }
