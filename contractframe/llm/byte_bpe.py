"""Byte-level BPE of whole texts as a monoid, reduced up a tree; decoding concatenates up a tree.

The ranks are a tiktoken file. A pattern cuts a text into matches, and each match is merged on its own: the
neighbouring pair whose joined bytes have the lowest rank first, the leftmost of equals; a match that is itself in
the vocabulary is that one token. The encodings of two neighbouring texts join into that of both, so a text is
encoded by halves, down to leaves of a few thousand characters, and a long match by halves of its bytes.

*Joining tokens of one match.* A token sequence is the encoding of its bytes exactly if every two neighbours, merged
alone, come out as themselves: as long as no merge crosses a border, those inside two neighbours are just the ones
that the two alone would see, in the same order, so the first merge across a border would also happen to them
alone. The join merges the bytes of a window around the seam anew. If its first token is the one that the
left side had there, that pair is known to hold, and everything before it stands; the same on the right. Otherwise the
window grows by the factor two on that side, at most to the whole.

*Joining matches.* A match hangs on the characters from its start alone. Near the left side's end some may have
ended for want of text: a match is settled once the character after it, and three from its start, have been
seen. Matching goes on from the last settled end into the right side until a match ends where one of the right
side's does; from there on both see the same. A match that merely runs on over the seam joins by its tokens.

On Spark: a text up to ``segment_bytes`` is one leaf of the outer tree and is reduced inside its task. Longer ones are
cut into segments that are dealt over all tasks, and neighbours are joined in rounds of a shuffle, eight nodes into one,
until one node per document is left: its ids are one value, as the text was.

Null texts are empty: no ids. Rows of one id, or of one id and text, each keep their own result. Extra columns are
ignored. An empty table gives an empty one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractframe.llm.common import batches, ground, materialize, ship_package, slices

LEAF_CHARS = 2048
LEAF_BYTES = 16
SEGMENT_BYTES = 1 << 16
FAN = 8
_CACHE_ENTRIES, _CACHE_CHARS = 400_000, 64
#: Characters from the start of a match that can decide it (an apostrophe and two letters).
_REACH = 3

# Letters and numbers that Unicode has added since version 16, the one of the tokenizer's library.
_NEWER_LETTERS = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959 "
    "10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8 16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA "
    "18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 "
    "1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E "
    "2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)
_NEWER_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"


def _ranges(codes: str) -> str:
    return "".join("-".join(rf"\U{int(c, 16):08x}" for c in part.split("-")) for part in codes.split())


class _Matches(dict):
    """match -> its ids as little-endian 32-bit bytes; forgets everything when full and keeps no long ones."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, match):
        ids = self.encode(match)
        if len(match) <= _CACHE_CHARS:
            if len(self) >= _CACHE_ENTRIES:
                self.clear()
            self[match] = ids
        return ids


class Node:
    """A text's matches and the ids of each."""

    __slots__ = ("matches", "ids")

    def __init__(self, matches: list[str], ids: list[bytes]):
        self.matches, self.ids = matches, ids


class Monoid:
    """Encodings by one vocabulary and pattern, and how two join."""

    def __init__(self, ranks: str, pattern: str):
        import regex

        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(str.split, ranks.splitlines())}
        self.no_rank = max(self.ranks.values()) + 1
        self.packed = {token: rank.to_bytes(4, "little") for token, rank in self.ranks.items()}
        self.token = {ids: token for token, ids in self.packed.items()}
        self.by_rank = {rank: token for token, rank in self.ranks.items()}
        self.find = regex.compile(pattern)
        strict = pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{_ranges(_NEWER_LETTERS + ' ' + _NEWER_NUMBERS)}])")
        strict = strict.replace(r" ?\p{L}+", rf" ?(?:(?![{_ranges(_NEWER_LETTERS)}])\p{{L}})+").replace(
            r" ?\p{N}+", rf" ?(?:(?![{_ranges(_NEWER_NUMBERS)}])\p{{N}})+")
        self.strict = regex.compile(strict)
        self.newer = regex.compile(f"[{_ranges(_NEWER_LETTERS + ' ' + _NEWER_NUMBERS)}]")
        self.known = _Matches(self.match_ids)

    def pattern_for(self, text: str):
        if text.isascii():
            return self.find
        try:
            text.encode("latin-1")  # quick, and older than any of the newer characters
            return self.find
        except UnicodeEncodeError:
            return self.strict if self.newer.search(text) else self.find

    # -- tokens of one match --

    def merged(self, text: bytes) -> list[bytes]:
        """The tokens of a few bytes, by merging the lowest rank first."""
        n, rank, none = len(text), self.ranks.get, self.no_rank
        parts = [text[i : i + 1] for i in range(n)]
        costs = [rank(text[i : i + 2], none) for i in range(n - 1)]
        while costs:
            least = min(costs)
            if least == none:
                break
            at = costs.index(least)
            joined = parts[at] = parts[at] + parts.pop(at + 1)
            del costs[at]
            if at:
                costs[at - 1] = rank(parts[at - 1] + joined, none)
            if at < len(costs):
                costs[at] = rank(joined + parts[at + 1], none)
        return parts

    def tokens(self, text: bytes) -> list[bytes]:
        """By halves of the bytes."""
        if len(text) <= LEAF_BYTES:
            return self.merged(text)
        middle = len(text) // 2
        return self.join_tokens(self.tokens(text[:middle]), self.tokens(text[middle:]))

    def join_tokens(self, left: list[bytes], right: list[bytes]) -> list[bytes]:
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = b"".join(left[len(left) - i :] + right[:j])
            # A window that has grown is encoded by halves, as any text; unless it is all there is.
            got = self.merged(window) if len(window) <= 8 * LEAF_BYTES or (i, j) == (len(left), len(right)) else self.tokens(window)
            stands_left = i == len(left) or got[0] == left[-i]
            stands_right = j == len(right) or got[-1] == right[j - 1]
            if stands_left and stands_right:
                return left[: len(left) - i] + got + right[j:]
            i, j = i if stands_left else 2 * i, j if stands_right else 2 * j

    def match_ids(self, match: str) -> bytes:
        text = match.encode()
        whole = self.packed.get(text)
        return whole if whole is not None else b"".join(map(self.packed.__getitem__, self.tokens(text)))

    def _merge_tokens(self, match: str, ids: bytes) -> list[bytes]:
        """The tokens that merging gives; a match taken whole from the vocabulary might come apart."""
        if len(ids) == 4:
            return self.tokens(match.encode())
        return [self.token[ids[i : i + 4]] for i in range(0, len(ids), 4)]

    # -- texts --

    def encode(self, text: str) -> Node:
        return self._encode(text, self.pattern_for(text))

    def _encode(self, text: str, pattern) -> Node:
        if len(text) <= LEAF_CHARS:
            matches = pattern.findall(text)
            return Node(matches, list(map(self.known.__getitem__, matches)))
        middle = len(text) // 2
        return self.join(self._encode(text[:middle], pattern), self._encode(text[middle:], pattern))

    def join(self, left: Node, right: Node) -> Node:
        """The encoding of both texts in a row; uses up the left one."""
        if not left.matches or not right.matches:
            return left if left.matches else right
        open_matches, open_ids, length = [], [], 0
        while left.matches and (not open_matches or length + len(left.matches[-1]) < _REACH):
            open_matches.append(left.matches.pop())
            open_ids.append(left.ids.pop())
            length += len(open_matches[-1])
        tail, n = "".join(reversed(open_matches)), 8
        while True:
            head = right.matches[:n]
            window, whole = tail + "".join(head), n >= len(right.matches)
            ends = {end: taken for taken, end in enumerate(accumulate(map(len, head), initial=length))}
            new, taken = [], None
            for match in self.pattern_for(window).finditer(window):
                start, end = match.span()
                if not whole and (end == len(window) or start + _REACH > len(window)):
                    break
                new.append(match)
                taken = ends.get(end)
                if taken is not None:
                    break
            if taken is not None:
                break
            n *= 2
        last = length - len(open_matches[0])
        for match in new:
            text = match.group()
            if len(text) > _CACHE_CHARS and match.span() == (last, length + len(right.matches[0])):
                sides = self._merge_tokens(open_matches[0], open_ids[0]), self._merge_tokens(right.matches[0], right.ids[0])
                ids = self.packed.get(text.encode()) or b"".join(map(self.packed.__getitem__, self.join_tokens(*sides)))
            else:
                ids = self.known[text]
            left.matches.append(text)
            left.ids.append(ids)
        left.matches.extend(right.matches[taken:])
        left.ids.extend(right.ids[taken:])
        return left

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the tokens, leaves of 4,096 tokens concatenated two by two."""
        ranks, token = np.frombuffer(ids, "<u4").tolist(), self.by_rank.__getitem__
        parts = [b"".join(map(token, ranks[at : at + 4096])) for at in range(0, len(ranks), 4096)]
        while len(parts) > 1:
            parts = [b"".join(parts[i : i + 2]) for i in range(0, len(parts), 2)]
        return parts[0] if parts else b""


_open: dict[int, Monoid] = {}


def monoid(ranks: str, pattern: str) -> Monoid:
    """The one of this Python worker; its cache lives as long as the worker."""
    key = hash((ranks, pattern))
    if key not in _open:
        _open.clear()
        _open[key] = Monoid(ranks, pattern)
    return _open[key]


# -- nodes as rows ---------------------------------------------------------------------

_NODE = "uid bigint, k bigint, text string, match_chars binary, match_ids binary, ids binary"


def _as_row(node: Node) -> tuple[str, bytes, bytes, bytes]:
    chars = np.fromiter(map(len, node.matches), "<u4", len(node.matches))
    sizes = np.fromiter(map(len, node.ids), "<u4", len(node.ids))
    return "".join(node.matches), chars.tobytes(), sizes.tobytes(), b"".join(node.ids)


def _as_node(text: str, chars: bytes, sizes: bytes, ids: bytes) -> Node:
    def cut(whole, lengths):
        ends = np.cumsum(np.frombuffer(lengths, "<u4"), dtype="int64").tolist()
        return [whole[a:b] for a, b in zip([0, *ends], ends)]

    return Node(cut(text, chars), cut(ids, sizes))


def _node_batch(uids: list, ks: list, nodes: list[Node]) -> dict:
    rows = list(zip(*map(_as_row, nodes))) or [[], [], [], []]
    types = [pa.string(), pa.binary(), pa.binary(), pa.binary()]
    names = ["text", "match_chars", "match_ids", "ids"]
    return {"uid": (uids, pa.int64()), "k": (ks, pa.int64()), **{n: (list(r), t) for n, r, t in zip(names, rows, types)}}


def _segments(data: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = SEGMENT_BYTES
    for batch in data:
        for row in range(batch.num_rows):
            uid, text = batch.column("uid")[row].as_py(), batch.column("text")[row].as_py()
            for k in range(0, -(-len(text) // size)):
                yield batches({"uid": ([uid], pa.int64()), "k": ([k], pa.int64()), "text": ([text[k * size : (k + 1) * size]], pa.string())})


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", segment_bytes: int | None = None) -> DataFrame:
    """``id_column`` and ids: all tokens of each text, as little-endian unsigned 32-bit integers."""
    spark, limit = docs.sparkSession, segment_bytes or SEGMENT_BYTES
    ship_package(spark)
    docs = ground(docs, doc_id=F.col(id_column), text=F.coalesce("text", F.lit("")))
    id_type = docs.schema["doc_id"].dataType
    out = T.StructType([T.StructField("doc_id", id_type), T.StructField("ids", T.BinaryType())])
    is_long = F.octet_length("text") > limit

    def encode_short(data):
        code = monoid(ranks, pattern)
        for whole in data:
            for batch in slices(whole, "text"):
                ids = [b"".join(code.encode(text).ids) for text in batch.column("text").to_pylist()]
                yield batches({"doc_id": (batch.column("doc_id"), None), "ids": (ids, pa.binary())})

    short = docs.where(~is_long).mapInArrow(encode_short, out)

    long = materialize(docs.where(is_long).withColumn("uid", F.monotonically_increasing_id()), "long-texts")
    cut = long.select("uid", "text").mapInArrow(_segments, "uid bigint, k bigint, text string")

    def encode_segments(data):
        code = monoid(ranks, pattern)
        for whole in data:
            for batch in slices(whole, "text"):
                nodes = [code.encode(text) for text in batch.column("text").to_pylist()]
                yield batches(_node_batch(batch.column("uid").to_pylist(), batch.column("k").to_pylist(), nodes))

    def join_neighbours(key, table):
        code = monoid(ranks, pattern)
        rows = sorted(table.drop_columns(["uid", "parent"]).to_pylist(), key=lambda r: r["k"])
        nodes = [_as_node(r["text"], r["match_chars"], r["match_ids"], r["ids"]) for r in rows]
        while len(nodes) > 1:
            nodes = [code.join(*nodes[i : i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
        return pa.Table.from_batches([batches(_node_batch([key[0].as_py()], [key[1].as_py()], nodes))])

    nodes = cut.repartition("uid", "k").mapInArrow(encode_segments, _NODE)
    most = long.agg(F.max(F.char_length("text"))).first()[0] or 0  # one number
    width = -(-most // SEGMENT_BYTES)
    while width > 1:
        nodes = nodes.withColumn("parent", F.expr(f"k div {FAN}")).groupBy("uid", "parent").applyInArrow(join_neighbours, _NODE)
        width = -(-width // FAN)
    joined = nodes.select("uid", "ids").join(long.select("uid", "doc_id"), "uid").select("doc_id", "ids")
    return short.unionByName(joined).withColumnRenamed("doc_id", id_column)


def decode_documents(encoded: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """The rows with decoded: the bytes of their ids."""
    ship_package(encoded.sparkSession)
    fields = [f for f in encoded.schema.fields if f.name != "decoded"]
    out = T.StructType([*fields, T.StructField("decoded", T.BinaryType())])

    def decode(data):
        code = monoid(ranks, pattern)
        for whole in data:
            for batch in slices(whole, "ids"):
                decoded = [code.decode(ids or b"") for ids in batch.column("ids").to_pylist()]
                yield batches({**{f.name: (batch.column(f.name), None) for f in fields}, "decoded": (decoded, pa.binary())})

    return encoded.select(*[f.name for f in fields]).mapInArrow(decode, out)
