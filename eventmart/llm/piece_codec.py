"""SentencePiece BPE encoding and decoding by a table of prefixes.

For merge-type vocabularies every prefix of a text has one encoding, and the last token of
that encoding is the only vocabulary entry that ends there and whose neighbour before, the
last token of the rest, forms a compatible pair with it: a pair that the merges leave as it
is. The table keeps this token for each prefix; an Aho-Corasick automaton names the entries
that end at each place, the pair test picks one, and the ids are read from the end back.

A text is cut where no entry crosses: before a blank that follows another character, and
around line feeds. What such a part encodes to is remembered, so a frequent word costs one
dictionary lookup. Ids are packed as little-endian unsigned 32-bit integers.

Runs of blanks are the one exception to the table: their entries all have the same score,
which makes the merge of a run depend on places and not on pairs. A part with more than one
leading blank is merged directly.

Defined cases: a null text counts as empty and gives the begin and end ids alone; repeated
rows give equal ids; extra columns pass through, but for those named like added columns,
which are replaced. Texts are never cut short.
"""

from __future__ import annotations

import heapq
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.crf import positions
from eventmart.llm.hashmap import HashMap
from eventmart.llm.textops import per_chunk

BLANK = "▁"
#: Parts remembered by one task before it starts afresh.
REMEMBERED = 250_000
#: Longer parts are worked one by one and not remembered.
BATCH_CHARS = 40
#: Parts that go through the table together.
BATCH_PARTS = 20_000


@dataclass
class Vocabulary:
    """Pieces of a model by id; special and byte pieces have no place in merges."""

    pieces: list[str]
    scores: list[float]
    ordinary: list[bool]
    byte_of: dict[int, int]  # id -> byte
    bos: int
    eos: int
    unknown: int
    codec: object = None


def load(path: str) -> Vocabulary:
    """Read a model file on the driver; its size is fixed by the vocabulary."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    byte_of = {i: int(sp.id_to_piece(i)[1:-1], 16) for i in range(n) if sp.is_byte(i)}
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
    return Vocabulary(
        [sp.id_to_piece(i) for i in range(n)],
        [sp.get_score(i) for i in range(n)],
        [not special[i] and i not in byte_of for i in range(n)],
        byte_of,
        sp.bos_id(),
        sp.eos_id(),
        sp.unk_id(),
    )


class Codec:
    """Encoder and decoder of one vocabulary, with its automaton and memory."""

    def __init__(self, vocabulary: Vocabulary):
        import ahocorasick

        v = self.vocabulary = vocabulary
        self.id_of = {p: i for i, p in enumerate(v.pieces) if v.ordinary[i]}
        self.bytes_id = {b: i for i, b in v.byte_of.items()}
        self.automaton = ahocorasick.Automaton()
        for piece in self.id_of:
            self.automaton.add_word(piece, (piece, len(piece)))
        self.automaton.make_automaton()
        longer = [p for p in self.id_of if len(p) > 1]
        blank_inside = any(BLANK in p.lstrip(BLANK) for p in longer)
        feed_inside = any("\n" in p for p in longer)
        feed = "" if feed_inside else r"\n|"
        inner = "[^ ]" if feed_inside else r"[^ \n]"
        # parts that no entry crosses; the whole text where the vocabulary rules that out
        self.parts = re.compile(r"(?s).+" if blank_inside else feed + rf" *{inner}+| +")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memory: dict[str, bytes] = {}
        self.table: PrefixTable | None = None
        self.head = np.uint32(v.bos).tobytes()
        self.tail = np.uint32(v.eos).tobytes()
        self.text_of = [
            bytes([v.byte_of[i]]) if i in v.byte_of
            else b"" if i in (v.bos, v.eos)
            else " ⁇ ".encode() if i == v.unknown
            else p.replace(BLANK, " ").encode()
            for i, p in enumerate(v.pieces)
        ]

    def merged(self, text: str) -> list[str]:
        """Direct merging: the best score first, then the leftmost place."""
        if len(text) > 32:
            return self._merged_long(text)
        parts, scores, get = list(text), self.vocabulary.scores, self.id_of.get
        ids = [get(a + b) for a, b in zip(parts, parts[1:], strict=False)]
        while True:
            best, at = None, -1
            for k, i in enumerate(ids):
                if i is not None and (best is None or scores[i] > best):
                    best, at = scores[i], k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ids[at]
            if at:
                ids[at - 1] = get(parts[at - 1] + parts[at])
            if at < len(ids):
                ids[at] = get(parts[at] + parts[at + 1])

    def _merged_long(self, text: str) -> list[str]:
        """The same by a queue of places."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        scores, id_of = self.vocabulary.scores, self.id_of
        queue: list[tuple[float, int, int, str]] = []

        def offer(i, j):
            both = parts[i] + parts[j]
            if (k := id_of.get(both)) is not None:
                heapq.heappush(queue, (-scores[k], i, j, both))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, both = heapq.heappop(queue)
            if parts[i] is None or parts[j] is None or parts[i] + parts[j] != both:
                continue
            if after[i] != j:
                continue
            parts[i], parts[j] = both, None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p is not None]

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging ``a + b`` leaves exactly these two; ``a`` is empty at the start."""
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        fits = self.pairs[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return fits

    def pieces_of(self, text: str) -> list[str]:
        """Pieces of a part (blanks already marked), from the table of prefixes."""
        if len(text) > 1 and text[0] == text[1] == BLANK:
            return self.merged(text)
        last: list[str] = []
        known = self.pairs.get
        for end, (piece, length) in self.automaton.iter(text):  # longest first at each end
            while len(last) < end:  # no entry ends there: the character is its own piece
                last.append(text[len(last)])
            if len(last) > end:
                continue
            key = ("" if length > end else last[end - length], piece)
            fits = known(key)
            if fits if fits is not None else self.compatible(*key):
                last.append(piece)
        last.extend(text[len(last) :])
        out, at = [], len(text)
        while at:
            out.append(last[at - 1])
            at -= len(out[-1])
        return out[::-1]

    def _packed(self, part: str) -> bytes:
        ids: list[int] = []
        for piece in self.pieces_of(part.replace(" ", BLANK)):
            if (i := self.id_of.get(piece)) is not None:
                ids.append(i)
            elif self.bytes_id:
                ids.extend(self.bytes_id[b] for b in piece.encode())
            else:
                ids.append(self.vocabulary.unknown)
        packed = np.array(ids, "<u4").tobytes()
        if len(part) <= BATCH_CHARS:
            if len(self.memory) >= REMEMBERED:
                self.memory.clear()
            self.memory[part] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """Packed ids with begin and end; a blank is put before the text."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """``encode`` of each; parts not seen before go through the table together."""
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        cut = [self.parts.findall(" " + t.replace(BLANK, " ")) if t else [] for t in texts]
        memory = self.memory
        fresh = {p for p in set().union(*cut) if p not in memory}
        if len(fresh) > 200:
            if self.table is None:
                self.table = PrefixTable(self)
            order = list(fresh)
            for a in range(0, len(order), BATCH_PARTS):
                memory.update(self.table.encode(set(order[a : a + BATCH_PARTS])))
        get = memory.get
        return [
            b"".join([self.head, *[get(p) or self._packed(p) for p in parts], self.tail])
            for parts in cut
        ]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; the blank before the text goes."""
        text = b"".join(map(self.text_of.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text.removeprefix(" ")


class PrefixTable:
    """The table of prefixes for many parts at once.

    Parts lie one after the other in one array of characters. A trie of the vocabulary is
    walked from every place together, which gives the entry of each length that ends at each
    place; then the places of all parts are filled from left to right.
    """

    def __init__(self, codec: Codec):
        self.codec, pieces = codec, codec.vocabulary.pieces
        self.n = len(pieces)
        chars = {c for p in codec.id_of for c in p}
        self.alphabet = np.array(sorted(map(ord, chars)), np.int64)
        number = {chr(c): k for k, c in enumerate(self.alphabet)}
        nodes: dict[str, int] = {"": 0}
        keys, values, entry = [], [], [-1]
        for piece, i in codec.id_of.items():
            for k in range(1, len(piece) + 1):
                if piece[:k] not in nodes:
                    nodes[piece[:k]] = len(entry)
                    keys.append(nodes[piece[: k - 1]] * len(number) + number[piece[k - 1]])
                    values.append(len(entry))
                    entry.append(-1)
            entry[nodes[piece]] = i
        self.entry = np.array(entry, np.int32)
        self.trie = HashMap()
        self.trie.insert(np.array(keys, np.int64), np.array(values, np.int32))
        self.longest = max(map(len, codec.id_of))
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.fits = HashMap()

    def compatible(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """``Codec.compatible`` for pairs of ids; ``before`` is n at the start of a part."""
        keys = before * self.n + ids
        known = self.fits.lookup(keys)
        if (known < 0).any():
            if self.fits.size > 4 * REMEMBERED:
                self.fits = HashMap()
            pieces, new = self.codec.vocabulary.pieces, np.unique(keys[known < 0])
            pairs = [("" if k // self.n == self.n else pieces[k // self.n], pieces[k % self.n])
                     for k in new.tolist()]
            merged = self.codec.merged
            found = [merged(a + b) == ([a, b] if a else [b]) for a, b in pairs]
            self.fits.insert(new, np.array(found, np.int32))
            known[known < 0] = self.fits.lookup(keys[known < 0])
        return known == 1

    def encode(self, parts: set[str]) -> dict[str, bytes]:
        """Packed ids of the parts that this table can hold: short, of known characters, and
        without a run of leading blanks."""
        picked = [p for p in parts if len(p) <= BATCH_CHARS and p[:2] != "  "]
        if not picked:
            return {}
        text = "".join(picked).replace(" ", BLANK)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        chars = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        known = self.alphabet[chars] == codes
        ends = np.cumsum([len(p) for p in picked])
        offsets = np.concatenate([[0], ends])
        unknown = np.concatenate([[0], np.cumsum(~known)])
        good = unknown[ends] == unknown[offsets[:-1]]
        if not good.all():
            return self.encode({p for p, ok in zip(picked, good, strict=True) if ok})
        stop = np.repeat(ends, np.diff(offsets))
        entries = np.full((self.longest + 1, len(chars)), -1, np.int32)
        start = np.arange(len(chars))
        node = np.zeros(len(chars), np.int64)
        for k in range(self.longest):
            inside = start + k < stop[start]
            start, node = start[inside], node[inside]
            node = self.trie.lookup(node * len(self.alphabet) + chars[start + k]).astype(np.int64)
            start, node = start[node >= 0], node[node >= 0]
            if not len(start):
                break
            entries[k + 1, start + k] = self.entry[node]
        last = np.full(len(chars), -1, np.int64)
        for t, rows in positions(offsets):
            for length in range(min(t + 1, self.longest), 0, -1):
                found = entries[length, rows]
                tried = np.flatnonzero(found >= 0)
                if not len(tried):
                    continue
                at, ids = rows[tried], found[tried].astype(np.int64)
                if length > t:
                    before = np.full(len(at), self.n, np.int64)
                else:
                    before = last[at - length]
                ok = self.compatible(before, ids)
                last[at[ok]] = ids[ok]
                rows = np.delete(rows, tried[ok])
        at, part, steps = ends - 1, np.arange(len(picked)), []
        while len(at):
            ids = last[at]
            steps.append((part, ids))
            at = at - self.length[ids]
            on = at >= offsets[part]
            at, part = at[on], part[on]
        part = np.concatenate([p for p, _ in steps][::-1])
        ids = np.concatenate([i for _, i in steps][::-1])
        packed = ids[np.argsort(part, kind="stable")].astype("<u4").tobytes()
        cuts = np.cumsum(np.bincount(part, minlength=len(picked)) * 4).tolist()
        return {p: packed[a:b] for p, a, b in zip(picked, [0, *cuts], cuts, strict=False)}


def _codec(shared) -> Codec:
    """The codec of this process; it stays with the broadcast vocabulary from task to task."""
    vocabulary = shared.value
    if vocabulary.codec is None:
        vocabulary.codec = Codec(vocabulary)
    return vocabulary.codec


def _broadcast(spark: SparkSession, path: str):
    return spark.sparkContext.broadcast(load(path))


def _plan(docs: DataFrame, read: str, added: dict[str, str], fn, shared) -> DataFrame:
    names = {c.lower() for c in added}
    carried = [f for f in docs.schema.fields if f.name.lower() not in names or f.name == read]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in carried]
        + [f"{c} {kind}" for c, kind in added.items()]
    )
    keep = [f.name for f in carried]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = _codec(shared)
        columns = {c: batch.column(c) for c in keep}
        return pa.RecordBatch.from_pydict(columns | fn(codec, batch.column(read)))

    wanted = docs.select(*[F.col(f"`{c}`") for c in keep])
    return wanted.mapInArrow(per_chunk(run, read), schema)


def default_model() -> str:
    """The installed 32k model; only the driver reads the file."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _ids(codec: Codec, texts: pa.Array) -> pa.Array:
    return pa.array(codec.encode_all([t or "" for t in texts.to_pylist()]), pa.binary())


def encode(docs: DataFrame, model: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (binary) and ``n_tokens`` (bigint)."""

    def fn(codec, texts):
        ids = _ids(codec, texts)
        sizes = [len(x) // 4 for x in ids.to_pylist()]
        return {"ids": ids, "n_tokens": pa.array(sizes, pa.int64())}

    shared = _broadcast(docs.sparkSession, model or default_model())
    return _plan(docs, text, {"ids": "binary", "n_tokens": "bigint"}, fn, shared)


def round_trip(docs: DataFrame, model: str | None = None, text: str = "text") -> DataFrame:
    """``encode``, and ``decoded``: the text that the ids give back."""

    def fn(codec, texts):
        ids = _ids(codec, texts)
        packed = ids.to_pylist()
        return {
            "ids": ids,
            "n_tokens": pa.array([len(x) // 4 for x in packed], pa.int64()),
            "decoded": pa.array(
                [codec.decode(np.frombuffer(x, "<u4")) for x in packed], pa.string()
            ),
        }

    shared = _broadcast(docs.sparkSession, model or default_model())
    added = {"ids": "binary", "n_tokens": "bigint", "decoded": "string"}
    return _plan(docs, text, added, fn, shared)
