"""A topic as a folder: keyed messages in partitions, positions, and a log of what was published.

``publish`` writes through a data source writer. Tasks stage their files; only the driver's commit lists
them in the topic's log, with the position each file begins at. Readers know files from the log alone, so what a failed or
repeated task has left is never seen. A key's messages all go to one partition, in the order given.

``messages`` reads the topic as a stream: from the earliest or the latest position, at most ``bound``
messages a micro-batch, restarted from the checkpoint. Where a group started and how far it has planned is
kept beside the log, so that a restart neither starts over nor takes more than it should.

It is no broker: there is no retention, and one publisher at a time may commit.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage

MESSAGE = "key string, value string"
RECORD = "partition int, position long, key string, value string"


class Folder:
    """The files of a topic."""

    def __init__(self, path: str) -> None:
        self.files, self.root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else f"file:{path.removeprefix('file:')}")

    def read(self, name: str) -> dict | None:
        at = f"{self.root}/{name}"
        if self.files.get_file_info(at).type == fs.FileType.NotFound:
            return None
        with self.files.open_input_stream(at) as stream:
            return json.loads(stream.read())

    def write(self, name: str, content: dict) -> None:
        """Replace a file in one step."""
        at, staged = f"{self.root}/{name}", f"{self.root}/{name}.{uuid.uuid4().hex}"
        self.files.create_dir(at.rpartition("/")[0])
        with self.files.open_output_stream(staged) as stream:
            stream.write(json.dumps(content).encode())
        self.files.move(staged, at)

    def log(self) -> list[dict]:
        """Published files: partition, first position, rows, name; commits in order."""
        listed = self.files.get_file_info(fs.FileSelector(f"{self.root}/log", allow_not_found=True))
        names = sorted(info.base_name for info in listed if info.base_name.endswith(".json"))
        return [entry for name in names for entry in self.read(f"log/{name}")["files"]]

    def ends(self, partitions: int) -> list[int]:
        found = [0] * partitions
        for entry in self.log():
            found[entry["partition"]] = max(found[entry["partition"]], entry["first"] + entry["rows"])
        return found


@dataclass
class Staged(WriterCommitMessage):
    files: list[tuple[int, str, int]]


class TopicWriter(DataSourceArrowWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        folder, writers, rows = Folder(self.path), {}, {}
        folder.files.create_dir(f"{folder.root}/data")
        try:
            for batch in iterator:
                table = pa.Table.from_batches([batch])
                for partition in sorted(pc.unique(table["partition"]).to_pylist()):
                    part = table.filter(pc.equal(table["partition"], partition)).select(["key", "value"])
                    if partition not in writers:
                        name = f"data/{uuid.uuid4().hex}.parquet"
                        writers[partition] = name, pq.ParquetWriter(f"{folder.root}/{name}", part.schema, filesystem=folder.files)
                    writers[partition][1].write_table(part)
                    rows[partition] = rows.get(partition, 0) + part.num_rows
        finally:
            for _, writer in writers.values():
                writer.close()
        return Staged([(partition, name, rows[partition]) for partition, (name, _) in writers.items()])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        folder = Folder(self.path)
        staged = sorted(x for message in messages if message is not None for x in message.files)
        ends, files = folder.ends(1 + max((x[0] for x in staged), default=0)), []
        for partition, name, rows in staged:
            files.append({"partition": partition, "first": ends[partition], "rows": rows, "name": name})
            ends[partition] += rows
        number = len(folder.files.get_file_info(fs.FileSelector(f"{folder.root}/log", allow_not_found=True)))
        folder.write(f"log/{number:010d}.json", {"files": files})

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        folder = Folder(self.path)
        for message in messages:
            for _, name, _ in message.files if message is not None else []:
                folder.files.delete_file(f"{folder.root}/{name}")


@dataclass
class FileRange(InputPartition):
    partition: int
    name: str
    first: int  # position of the file's first message
    begin: int
    end: int


class TopicReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.path, self.partitions_n = options["path"], int(options["partitions"])
        self.start, self.bound = options.get("start", "earliest"), int(options.get("bound", 0))
        self.group = f"groups/{options['group']}.json"

    def _places(self) -> dict:
        folder = Folder(self.path)
        places = folder.read(self.group)
        if places is None:
            begin = folder.ends(self.partitions_n) if self.start == "latest" else [0] * self.partitions_n
            places = {"start": begin, "planned": begin}
            folder.write(self.group, places)
        return places

    def initialOffset(self) -> dict:  # noqa: N802
        return {str(k): at for k, at in enumerate(self._places()["start"])}

    def latestOffset(self) -> dict:  # noqa: N802
        """The end of the next micro-batch: ``bound`` messages beyond what was planned before, dealt to the partitions by turns."""
        folder, places = Folder(self.path), self._places()
        planned, ends = places["planned"], folder.ends(self.partitions_n)
        if self.bound:
            left, wanted = self.bound, [end - at for at, end in zip(planned, ends)]
            taken = [0] * len(wanted)
            while left and any(w > t for w, t in zip(wanted, taken)):
                waiting = [k for k, (w, t) in enumerate(zip(wanted, taken)) if w > t]
                share = max(left // len(waiting), 1)
                for k in waiting[:left]:
                    more = min(share, wanted[k] - taken[k], left)
                    taken[k], left = taken[k] + more, left - more
            ends = [at + more for at, more in zip(planned, taken)]
        if ends != planned:
            # Kept before Spark writes the micro-batch down: a restart never plans behind its checkpoint.
            folder.write(self.group, {"start": places["start"], "planned": ends})
        return {str(k): end for k, end in enumerate(ends)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        ranges = []
        for entry in Folder(self.path).log():
            low, high = start[str(entry["partition"])], end[str(entry["partition"])]
            begin, stop = max(low, entry["first"]), min(high, entry["first"] + entry["rows"])
            if begin < stop:
                ranges.append(FileRange(entry["partition"], entry["name"], entry["first"], begin, stop))
        return ranges

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        folder, at = Folder(self.path), partition.first
        with folder.files.open_input_file(f"{folder.root}/{partition.name}") as file:
            parquet = pq.ParquetFile(file)
            lengths = [parquet.metadata.row_group(k).num_rows for k in range(parquet.num_row_groups)]
            firsts = list(accumulate(lengths, initial=at))
            # Only the row groups of the range: a file is read once over all its micro-batches, not once for each.
            groups = [k for k, first in enumerate(firsts[:-1]) if first < partition.end and first + lengths[k] > partition.begin]
            at = firsts[groups[0]] if groups else partition.end
            for batch in parquet.iter_batches(row_groups=groups):
                low, high = max(partition.begin - at, 0), min(partition.end - at, batch.num_rows)
                if low < high:
                    part = batch.slice(low, high - low)
                    yield pa.RecordBatch.from_arrays([
                        pa.repeat(pa.scalar(partition.partition, pa.int32()), part.num_rows), pa.array(np.arange(at + low, at + high)), *part.columns,
                    ], names=["partition", "position", "key", "value"])
                at += batch.num_rows


class Topic(DataSource):
    """``spark.readStream.format("topic")`` and ``df.write.format("topic")``."""

    @classmethod
    def name(cls) -> str:
        return "topic"

    def schema(self) -> str:
        return RECORD

    def streamReader(self, schema) -> TopicReader:  # noqa: N802
        return TopicReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> TopicWriter:
        return TopicWriter(self.options["path"])


def _known(spark: SparkSession) -> None:
    """Name the source in this session, unless it is named already."""
    try:
        spark.dataSource.register(Topic)
    except AnalysisException as error:
        if error.getCondition() != "DATA_SOURCE_ALREADY_EXISTS":
            raise


def publish(messages: DataFrame, path: str, partitions: int, order: Sequence[str] = ()) -> None:
    """Append messages (key, value) to a topic; those of a key stay in the order of ``order``, a null key is a key."""
    spark = messages.sparkSession
    _known(spark)
    dealt = messages.withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int"))
    sorted_rows = dealt.repartition(partitions, "partition").sortWithinPartitions("partition", *order)
    sorted_rows.select("partition", "key", "value").write.format("topic").mode("append").save(path)


def read_topic(spark: SparkSession, path: str, partitions: int, group: str, start: str = "earliest", bound: int = 0) -> DataFrame:
    """Stream of partition, position, key and value; ``bound`` messages a micro-batch, 0 for all there are."""
    if start not in ("earliest", "latest"):
        raise ValueError("start must be earliest or latest")
    _known(spark)
    options = {"partitions": partitions, "group": group, "start": start, "bound": bound}
    return spark.readStream.format("topic").options(**options).load(path)
