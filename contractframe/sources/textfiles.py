"""Text files in pieces of bounded size, and the contracts among them."""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractframe.sources import firstbytes
from contractframe.storage import ship_package

PIECE = 4 << 20  # characters after which a piece ends at the next safe line break
LONGEST = 64 << 20  # characters after which it ends at any line break, or anywhere if there is none
CONTRACT_BYTES = 16 << 20  # larger YAML files are texts

#: Line breaks that a finding may hold lie between a letter or digit and a digit or one of "in" and "4".
_LINKED = re.compile(r"[^\W_]\s*\n\s*[\diIİı]")


def pieces(read: Callable[[int], bytes], size: int, longest: int | None = None) -> Iterator[str]:
    """The text in pieces, each cut where no finding can go on: findings of the pieces are those of the text."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    held, longest, more = "", longest or LONGEST, True
    looked = size  # how far breaks have been judged
    while more:
        packed = read(1 << 20)
        more = bool(packed)
        held += decoder.decode(packed, final=not more)
        while len(held) > looked:
            at = held.find("\n", looked)
            # A break is judged by what follows it, so that has to be there.
            follow = re.compile(r"\S").search(held, at) if at >= 0 else None
            if at >= 0 and not follow and more and len(held) < longest:
                break
            if at < 0 and more and len(held) < longest:
                looked = len(held)
                break
            if at >= 0 and follow:
                before = held[max(0, at - 1) : at].strip()
                start = at - 1
                while not before and start > 0:
                    start -= 1
                    before = held[start].strip()
                linked = _LINKED.match(held, max(start, 0), follow.end())
                if not linked:
                    yield held[: at + 1]
                    held, looked = held[at + 1 :], size
                    continue
            if len(held) >= longest:
                end = held.rfind("\n", 0, longest) + 1 or longest
                yield held[:end]
                held, looked = held[end:], size
                continue
            if at < 0 or not follow:
                break
            looked = at + 1
    if held:
        yield held


def _contract(text: str):
    """The contract that a YAML text is, or None."""
    import yaml

    from contractframe.contract import contract_from_dict

    try:
        return contract_from_dict(yaml.safe_load(text))
    except Exception:  # noqa: BLE001 -- whatever is wrong with it, the file is then a text
        return None


_ROWS = (
    "file string, yaml boolean, value string, dataset string, field_name string, notes string, community_notes string, "
    "shareable boolean, allowed_values array<string>"
)


def text_pieces(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """All matching files under a folder: pieces of their text (value), or the fields of a contract, a row each.

    A file is streamed by one task, however long; only contracts are held whole.
    """
    ship_package(spark)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    listed = listed.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))

    size_of_pieces = PIECE  # as it is here, not in the workers

    def read_files(data):
        import pyarrow as pa

        names = [c.split()[0] for c in _ROWS.split(", ")]
        types = [pa.string(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.list_(pa.string())]

        def out(rows):
            columns = list(zip(*rows)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        def texts(value):
            return None if value is None else str(value)

        for batch in data:
            for file, size in zip(batch.column("file").to_pylist(), batch.column("size").to_pylist()):
                is_yaml, contract = file.lower().endswith((".yaml", ".yml")), None
                if is_yaml and size <= CONTRACT_BYTES:
                    try:
                        contract = _contract(firstbytes.opened(file).read(CONTRACT_BYTES + 1).decode())
                    except UnicodeDecodeError:
                        pass
                if contract:
                    yield out([
                        (file, True, None, contract.dataset_name, f.name, texts(f.notes), texts(f.community_notes), bool(f.shareable),
                         [v for v in f.allowed_values if isinstance(v, str)] if f.allowed_values else None)
                        for f in contract.fields
                    ])
                    continue
                for piece in pieces(firstbytes.opened(file).read, size_of_pieces):
                    yield out([(file, is_yaml, piece, None, None, None, None, None, None)])

    return listed.mapInArrow(read_files, _ROWS)
