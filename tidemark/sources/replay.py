"""Paced replay of line files (S2, UF9): ``lines_per_trigger`` lines a micro-batch, in file order.

A Python data source whose offsets are places in the files: file number, byte and lines so far.
The pace is the query's trigger; the stream ends with the last line of the last file
(``replay_to_end``), or when the query is stopped, and a query that restarts from its checkpoint
goes on behind the last line that it committed.  The driver reads at most one batch of lines at
a time: pacing is sequential by nature, and large inputs are read by Spark's own file sources.

    spark.dataSource.register(LineReplay)
    spark.readStream.format("line_replay").option("path", folder).option("lines_per_trigger", 1).load()

Rows are ``value string, seq long``; ``seq`` counts lines from 1 over all files, by name.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

_BLOCK = 1 << 16


class LineReplay(DataSource):
    @classmethod
    def name(cls) -> str:
        return "line_replay"

    def schema(self) -> str:
        return "value string, seq long"

    def simpleStreamReader(self, schema) -> LineReader:
        return LineReader(self.options["path"], int(self.options.get("lines_per_trigger", "1")))


class LineReader(SimpleDataSourceStreamReader):
    def __init__(self, path: str, lines_per_trigger: int):
        if lines_per_trigger < 1:
            raise ValueError("lines_per_trigger must be at least 1")
        self.path, self.most = path, lines_per_trigger

    def _files(self):
        """File system and the files by name; a path may be a file, a folder or a URI of either."""
        from pyarrow import fs

        path = "/" + self.path.removeprefix("file:").lstrip("/") if self.path.startswith("file:") else self.path
        system, at = fs.FileSystem.from_uri(path)
        if system.get_file_info(at).type == fs.FileType.Directory:
            found = system.get_file_info(fs.FileSelector(at))
            hidden = lambda i: i.base_name.startswith(("_", "."))
            return system, sorted(i.path for i in found if i.type == fs.FileType.File and not hidden(i))
        return system, [at]

    def _lines(self, start: dict) -> Iterator[tuple[str, dict]]:
        """Lines behind ``start``, each with the offset after it."""
        system, files = self._files()
        line = start["line"]
        for k in range(start["file"], len(files)):
            with system.open_input_file(files[k]) as f:
                at = start["byte"] if k == start["file"] else 0
                f.seek(at)
                rest = b""
                while block := f.read(_BLOCK):
                    *whole, rest = (rest + block).split(b"\n")
                    for text in whole:
                        at, line = at + len(text) + 1, line + 1
                        yield text.decode(), {"file": k, "byte": at, "line": line}
                if rest:  # the last line of a file may have no line end
                    line += 1
                    yield rest.decode(), {"file": k, "byte": at + len(rest), "line": line}

    def initialOffset(self) -> dict:
        return {"file": 0, "byte": 0, "line": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        rows, end = [], start
        for text, after in self._lines(start):
            rows.append((text, after["line"]))
            end = after
            if len(rows) == self.most:
                break
        return iter(rows), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for text, after in self._lines(start):
            if after["line"] > end["line"]:
                return
            yield text, after["line"]

    def commit(self, end: dict) -> None:
        pass


def replay_to_end(writer: DataStreamWriter, checkpoint: str, pace: str = "0 seconds") -> StreamingQuery:
    """Run a query over a ``line_replay`` stream, one batch per ``pace``, until the last line."""
    query = writer.option("checkpointLocation", checkpoint).trigger(processingTime=pace).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query
