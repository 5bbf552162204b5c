"""A growing log as a streaming source (S07): lines appended to any file of a folder, once each.

Offsets are a byte position for each file, so a restart goes on where the checkpoint stopped and a file
of a new day joins when it appears.  Only whole lines are handed out; a last line without its end waits.
A file that has become shorter was begun anew and is read from its start.  A batch's new bytes are dealt
in pieces of ``PIECE`` bytes; a line belongs to the piece in which it begins.

    spark.dataSource.register(LogTail)
    spark.readStream.format("log_tail").option("path", folder).load()

Options: path, suffix (of the files that count, default all), maxBytesPerTrigger.  The folder is any that pyarrow's
file systems reach.
"""

from __future__ import annotations

import io
import os
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

PIECE = 8 << 20
_BACK = 1 << 16  # bytes read at a time when looking for the last line's end


class Piece(InputPartition):
    def __init__(self, path: str, low: int, high: int, first: bool):
        self.path, self.low, self.high, self.first = path, low, high, first


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class LogTailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.suffix = options["path"], options.get("suffix", "")
        self.most = int(options.get("maxbytespertrigger", options.get("maxBytesPerTrigger", 1 << 62)))
        self.served: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def _sizes(self) -> dict[str, int]:
        from pyarrow import fs

        system, root = _filesystem(self.path)
        found = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        return {i.path: i.size for i in sorted(found, key=lambda i: i.path)
                if i.is_file and i.path.endswith(self.suffix) and not i.base_name.startswith((".", "_"))}

    def _whole_lines(self, path: str, low: int, high: int) -> int:
        """Where the last whole line before ``high`` ends."""
        system, _ = _filesystem(self.path)
        with system.open_input_file(path) as f:
            while high > low:
                start = max(low, high - _BACK)
                f.seek(start)
                at = f.read(high - start).rfind(b"\n")
                if at >= 0:
                    return start + at + 1
                high = start
        return low

    def latestOffset(self) -> dict:
        out, left = {}, self.most
        for path, size in self._sizes().items():
            low = self.served.get(path, 0)
            low = low if low <= size else 0
            high = self._whole_lines(path, low, min(size, low + left)) if size > low and left > 0 else low
            if high == low and size > low + left > low:  # one line longer than the bound
                high = self._line_end(path, low, size)
            left -= high - low
            out[path] = high
        self.served = dict(out)
        return out

    def _line_end(self, path: str, low: int, size: int) -> int:
        system, _ = _filesystem(self.path)
        with system.open_input_file(path) as f:
            at = low
            while at < size:
                f.seek(at)
                found = f.read(min(PIECE, size - at)).find(b"\n")
                if found >= 0:
                    return at + found + 1
                at += PIECE
        return low

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        self.served = {**start, **end} if not self.served else self.served
        out = []
        for path, high in end.items():
            low = start.get(path, 0)
            low = low if low <= high else 0
            out += [Piece(path, at, min(at + PIECE, high), at == low) for at in range(low, high, PIECE)]
        return out

    def read(self, piece: Piece) -> Iterator[tuple]:
        system, _ = _filesystem(self.path)
        name = os.path.basename(piece.path)
        with system.open_input_file(piece.path) as raw:
            f, at = io.BufferedReader(raw), piece.low
            if not piece.first:  # the line that began in the piece before is that one's
                f.seek(piece.low - 1)
                at = piece.low - 1 + len(f.readline())
            f.seek(at)
            while at < piece.high:
                line = f.readline()
                if not line:
                    break
                yield name, at, line.rstrip(b"\r\n").decode("utf-8", "replace")
                at += len(line)

    def commit(self, end: dict) -> None:
        pass


class LogTail(DataSource):
    """file string, position long, line string."""

    @classmethod
    def name(cls) -> str:
        return "log_tail"

    def schema(self) -> str:
        return "file string, position long, line string"

    def streamReader(self, schema) -> LogTailReader:
        return LogTailReader(self.options)
