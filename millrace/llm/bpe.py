"""Byte-level BPE with forced boundaries.

A pair of bytes that occurs inside no vocabulary token can never be merged across, so the
place between them is a certain cut: the parts are encoded on their own and joined.
Texts are first cut in front of spaces (a certain cut of the vocabulary at which the
pre-tokenizer always ends a match as well), then pre-tokenized and cut again at every
other forced pair.  Each piece between cuts is merged on its own.  Parts repeat,
so their ids are remembered in a bounded table.

Null and empty texts have no ids and decode to the empty text.  Rows are independent:
repeated rows repeat, extra columns are ignored, an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from millrace.llm.common import arrow_pass, bounded, string_array

# The pre-tokenizer pattern of byte-level BPE vocabularies (fixed value).
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
REMEMBERED_BYTES = 24 << 20  # memory that the parts remembered by one worker may take
ENTRY_BYTES = 200  # of a remembered part besides its characters and ids
SHORT = 48  # bytes; longer parts are merged with a heap and not remembered


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes: printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Known(dict):
    """Ids of parts; a part that is missing is encoded and remembered while there is room."""

    def __init__(self, encode):
        super().__init__()
        self.encode, self.room = encode, REMEMBERED_BYTES

    def __missing__(self, part: str) -> tuple[int, ...]:
        ids = self.encode(part)
        if len(part) <= SHORT:
            self.room -= ENTRY_BYTES + len(part) + 8 * len(ids)
            if self.room < 0:
                self.clear()
                self.room = REMEMBERED_BYTES
            self[part] = ids
        return ids


class ByteBpe:
    """Encoder and decoder over the text of a tokenizer file."""

    def __init__(self, text: str):
        data = json.loads(text)
        letters = byte_alphabet()
        vocab = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens = [b""] * size
        for name, i in vocab.items():
            self.tokens[i] = bytes(letters[c] for c in name) if name not in self.special else name.encode()
        for name, i in self.special.items():
            self.tokens[i] = name.encode()
        self.byte_id = [0] * 256
        for c, b in letters.items():
            self.byte_id[b] = vocab[c]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(data["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[left], vocab[right]] = (rank, vocab[left + right])
        inside = np.zeros((256, 256), bool)
        for i, token in enumerate(self.tokens):
            if i not in self.special.values() and len(token) > 1:
                codes = np.frombuffer(token, np.uint8)
                inside[codes[:-1], codes[1:]] = True
        self.inside, self.joins = inside, inside.tobytes()
        # Bytes behind which a space is no certain cut; every other solid character has one.
        self.open_bytes = frozenset(np.flatnonzero(inside[:, 0x20]).tolist())
        ends = b"".join(bytes([b]) for b in sorted(self.open_bytes | {*b" \t\n\x0b\f\r\x1c\x1d\x1e\x1f"}))
        self.no_cut = re.compile(b"[" + re.escape(ends) + b"] |\xc2\x85 |\xe1\x9a\x80 |\xe2\x80[\x80-\x8a\xa8\xa9\xaf] |\xe2\x81\x9f |\xe3\x80\x80 ")
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.known = Known(self._part)
        # Where ids follow the order of the merges, a piece's merges can run in compiled code.
        order = [new for _, new in sorted(self.merges.values())]
        self.core = None
        if order == sorted(order) and all(i < order[0] for i in self.byte_id):
            ranks = {t: i for i, t in enumerate(self.tokens) if t and i not in self.special.values()}
            self.core = tiktoken.Encoding("parts", pat_str=PRETOKEN.pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe

    def encode(self, text: str) -> list[int]:
        if self.split_special and any(s in text for s in self.special):
            ids: list[int] = []
            for part in self.split_special.split(text):
                ids.extend([self.special[part]] if part in self.special else self._plain(part))
            return ids
        return self._plain(text)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")

    def length(self, token: str) -> int:
        """Number of ids of a pre-token."""
        return len(self._part(token))

    def fragments(self, text: str) -> list[str]:
        """The text cut in front of every space that follows a solid character."""
        first, *rest = text.split(" ")
        if first and not self.no_cut.search(text.encode()):
            return [first, *[" " + r for r in rest]]
        out, whole = [first], self._solid(first)
        for r in rest:
            if whole:
                out.append(" " + r)
            else:
                out[-1] += " " + r
            whole = self._solid(r)
        return out

    def _solid(self, piece: str) -> bool:
        """Whether a cut behind this piece is certain."""
        return piece != "" and not piece[-1].isspace() and piece[-1].encode()[-1] not in self.open_bytes

    def _plain(self, text: str) -> list[int]:
        if not text:
            return []
        return list(chain.from_iterable(map(self.known.__getitem__, self.fragments(text))))

    def _part(self, part: str) -> tuple[int, ...]:
        out: list[int] = []
        for token in PRETOKEN.findall(part):
            codes = token.encode()
            if len(codes) <= 3:  # too short for a cut to pay
                out.extend(self._merged(codes))
                continue
            joins, start = self.joins, 0
            cuts = [i for i, (a, b) in enumerate(zip(codes, codes[1:]), 1) if not joins[a << 8 | b]]
            for end in [*cuts, len(codes)]:
                piece = codes[start:end]
                out.extend(self._merged(piece))
                start = end
        return tuple(out)

    def _merged(self, piece: bytes) -> list[int]:
        if len(piece) == 1:
            return [self.byte_id[piece[0]]]
        if len(piece) > SHORT:
            return self._heap(piece)
        return self.core.encode_single_piece(piece) if self.core else self._scan(piece)

    def _scan(self, piece: bytes) -> list[int]:
        """Merge the leftmost pair of lowest rank until none is left."""
        ids = [self.byte_id[b] for b in piece]
        merges = self.merges
        while len(ids) > 1:
            best, at = None, -1
            for i in range(len(ids) - 1):
                found = merges.get((ids[i], ids[i + 1]))
                if found is not None and (best is None or found[0] < best[0]):
                    best, at = found, i
            if best is None:
                break
            ids[at : at + 2] = [best[1]]
        return ids

    def _heap(self, piece: bytes) -> list[int]:
        """As _scan, in n log n: pairs wait in a heap, ids form a linked list."""
        ids: list[int | None] = [self.byte_id[b] for b in piece]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := self.merges.get((ids[i], ids[i + 1])))]
        heap = [(rank, i, new, a, b) for rank, new, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if left >= 0 and right < n and (m := self.merges.get((ids[left], ids[right]))):
                    heapq.heappush(heap, (m[0], left, m[1], ids[left], ids[right]))
        return [x for x in ids if x is not None]


@lru_cache(maxsize=2)
def encoder(text: str) -> ByteBpe:
    return ByteBpe(text)


def encode_documents(docs: DataFrame, tokenizer_path: str, keep: tuple[str, ...] = ("doc_id",), decode: bool = True) -> DataFrame:
    """Columns ``keep``, token_ids (array of int) and, if asked for, decoded (the text made from the ids).

    The vocabulary file is read by the driver and sent to the tasks; its size is fixed.
    """
    spark = bounded(docs.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as file:
        vocabulary = spark.sparkContext.broadcast(file.read())
    source = docs.select(*keep, docs["text"].alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema)

    def make():
        bpe = encoder(vocabulary.value)

        def run(batch: pa.RecordBatch) -> dict:
            ids, decoded = [], []
            for value in batch.column(len(keep)):
                own = bpe.encode(value.as_py() or "")
                ids.append(np.array(own, np.int32))
                if decode:
                    decoded.append(bpe.decode(own))
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            columns = {name: batch.column(i) for i, name in enumerate(keep)}
            columns["token_ids"] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            return columns | ({"decoded": string_array(decoded)} if decode else {})

        return run

    return arrow_pass(source, f"{kinds}, token_ids array<int>" + ", decoded string" * decode, make)
