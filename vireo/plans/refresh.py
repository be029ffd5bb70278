"""Readings kept by quarter and refreshed from the files that changed.

Below ``root`` lie parts (folders of readings by quarter) and numbered
commits. A commit names the files it was made from (path, length and
modification time) and, for every quarter, the folder that holds it. A refresh
lists the input, reads the files that are new or changed, and takes the lines
named there, those of orders named there, and those kept from files that are
gone. Only the readings of these lines are made again, from the whole input, so
a copy in another file steps in for one that went. The quarters that held or now hold any of them are written to a
new part; all others stay where they are. Readers see one commit or the next,
never a mixture. Of two refreshes at once the second starts over on top of the
first.

The readings remember the files of their line and their order by name, length
and modification time; a file rewritten with none of these changed is not
noticed. Null order keys have no reading and are passed over. An input without
files has no readings (None).
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.functions.temporal import quarter_index
from vireo.plans.staging import LINE_KEY, order_lines, stg_readings
from vireo.session import scratch_path
from vireo.sources import storage
from vireo.sources.tables import Sources

#: Table, its order key, and the column of the readings that names its file.
TRACKED = (("lineitem", "l_orderkey", "line_file"), ("orders", "o_orderkey", "order_file"))
Files = dict[str, list[int]]
READING_KEY = ["reading_order", "reading_line"]
#: Column names of a list of lines.
KEY = ["touched_order", "touched_line"]


def file_version() -> Column:
    """Name, length and modification time (ms) of the file a scanned row lies in."""
    m = F.col("_metadata")
    return F.concat_ws("|", m["file_name"], m["file_size"], F.unix_millis(m["file_modification_time"]))


def data_files(spark: SparkSession, path: str) -> Files:
    """Data files at or below a path, with length and modification time."""
    return {p: [size, changed] for p, size, changed in storage.listing(spark, path) if not p.rsplit("/", 1)[1].startswith(("_", "."))}


def _versions(spark: SparkSession, files: Files) -> list[str]:
    """The ``file_version`` of listed files; a name that a URI escapes counts in both forms."""
    return sorted({f"{name}|{size}|{changed}" for p, (size, changed) in files.items()
                   for name in (p.rsplit("/", 1)[1], storage.escaped_name(spark, p))})


class ReadingMart:
    """The readings of ``lineitem`` and ``orders`` below ``sf_dir``, kept below ``root``."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        self.spark, self.sf_dir, self.root = spark, sf_dir, root
        self.commits = storage.CommitLog(spark, root)

    def _source(self, table: str, files: list[str], column: str | None = None) -> DataFrame:
        rows = self.spark.read.parquet(*files)
        return rows.withColumn(column, file_version()) if column else rows

    def _built(self, files: dict[str, Files], touched: DataFrame | None) -> DataFrame:
        """Readings with their files and quarter, of the given lines (None: of all)."""
        frames = {table: self._source(table, sorted(files[table]), column) for table, _, column in TRACKED}
        if touched is not None:
            frames["lineitem"] = frames["lineitem"].join(touched, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(LINE_KEY, KEY, strict=True)], "left_semi")
            frames["orders"] = frames["orders"].join(touched, F.col("o_orderkey") == F.col(KEY[0]), "left_semi")
        lines = order_lines(frames["lineitem"])
        src = Sources(self.spark, {table: (lambda rows=rows: rows) for table, rows in frames.items()})
        readings = stg_readings(src, lines, carried=[column for _, _, column in TRACKED])
        return readings.withColumn("quarter_no", F.coalesce(quarter_index("read_at"), F.lit(0)))

    def _stored(self, quarters: dict[str, str]) -> DataFrame:
        """The readings of stored quarters, each with its number."""
        by_part: dict[str, list[str]] = {}
        for quarter, part in quarters.items():
            by_part.setdefault(part, []).append(f"{part}/quarter_no={quarter}")
        return reduce(DataFrame.unionByName, [self.spark.read.option("basePath", part).parquet(*sorted(paths)) for part, paths in sorted(by_part.items())])

    def _touched_lines(self, files: dict[str, Files], state: dict) -> DataFrame | None:
        """Lines in files that came, of orders in files that came, or kept from files that went; None if there are no such files."""
        found = []
        for table, key, column in TRACKED:
            old = state["files"][table]
            came = [p for p, version in files[table].items() if old.get(p) != version]
            gone = {p: version for p, version in old.items() if files[table].get(p) != version}
            if came and table == "lineitem":
                found.append(self._source(table, sorted(came)).select(*LINE_KEY))
            elif came and files["lineitem"]:
                found.append(self._source("lineitem", sorted(files["lineitem"]))
                             .join(self._source(table, sorted(came)), F.col(LINE_KEY[0]) == F.col(key), "left_semi").select(*LINE_KEY))
            if gone and state["quarters"]:
                names = self.spark.createDataFrame([(v,) for v in _versions(self.spark, gone)], f"{column} string")
                found.append(self._stored(state["quarters"]).join(names, column, "left_semi").select(*READING_KEY))
            if not found and (came or gone):
                found.append(self.spark.createDataFrame([], "a long, b int"))
        return reduce(DataFrame.union, found).toDF(*KEY).where(f"{KEY[0]} IS NOT NULL").distinct() if found else None

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Rows as a new part; the quarters it holds."""
        part = f"{self.root}/parts/{uuid.uuid4().hex}"
        rows.write.partitionBy("quarter_no").option("compression", "zstd").parquet(part)
        return {name.split("=")[1]: part for name in storage.children(self.spark, part) if name.startswith("quarter_no=")}

    def refresh(self) -> list[int]:
        """Bring the mart up to the input; the quarters that were written or emptied."""
        while True:
            # numbers first: a commit that comes after this line has the number that is tried
            number = max(self.commits.numbers(), default=-1) + 1
            state = self.commits.latest()[1]
            files = {table: data_files(self.spark, f"{self.sf_dir}/{table}.parquet") for table, _, _ in TRACKED}
            if state is None:
                touched: set[str] = set()
                quarters = self._write(self._built(files, None)) if all(files.values()) else {}
                touched.update(quarters)
            else:
                lines = self._touched_lines(files, state)
                if lines is None:
                    return []
                quarters, touched = self._merged(files, state["quarters"], lines)
            if self.commits.add(number, {"files": files, "quarters": quarters}):
                return sorted(map(int, touched))

    def _merged(self, files: dict[str, Files], quarters: dict[str, str], lines: DataFrame) -> tuple[dict[str, str], set[str]]:
        """The quarters after the readings of ``lines`` are made again, and those among them that are touched."""
        def kept(rows: DataFrame, name: str) -> DataFrame:
            path = scratch_path(self.spark, name)
            rows.write.parquet(path)
            return self.spark.read.parquet(path)

        lines = kept(lines, "refresh-lines")
        same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(READING_KEY, KEY, strict=True)]
        fresh = kept(self._built(files, lines), "refresh-readings") if all(files.values()) else None
        held = self._stored(quarters).join(lines, same, "left_semi") if quarters else None
        # a calendar's worth of numbers
        touched = {str(r.quarter_no) for rows in (held, fresh) if rows is not None for r in rows.select("quarter_no").distinct().collect()}
        parts = [fresh] if fresh is not None else []
        if old := {q: p for q, p in quarters.items() if q in touched}:
            parts.append(self._stored(old).join(lines, same, "left_anti"))
        new = self._write(reduce(DataFrame.unionByName, parts)) if parts and touched else {}
        return {**{q: p for q, p in quarters.items() if q not in touched}, **new}, touched

    def readings(self, as_of: int | None = None) -> DataFrame | None:
        """The readings as of a commit (default: the last one; None before the first, or if it has none)."""
        state = self.commits.latest()[1] if as_of is None else self.commits.read(as_of)
        if not state or not state["quarters"]:
            return None
        return self._stored(state["quarters"]).drop("quarter_no", *[column for _, _, column in TRACKED])

    def vacuum(self, keep: int = 1) -> int:
        """Drop all but the last ``keep`` commits and the parts that these do not name; returns how many parts.

        Only to be run while nothing is being refreshed: a part that is written but not committed looks left over.
        """
        kept = self.commits.numbers()[-keep:]
        named = {part for n in kept for part in (self.commits.read(n) or {"quarters": {}})["quarters"].values()}
        old = [p for p in storage.children(self.spark, f"{self.root}/parts") if f"{self.root}/parts/{p}" not in named]
        for p in old:
            storage.delete(self.spark, f"{self.root}/parts/{p}")
        if kept:
            self.commits.forget_before(kept[0])
        return len(old)
