"""Byte-level BPE encoding and decoding with a token automaton (operator 6).

The merge list is compiled into a deterministic automaton over *tokens* by applying one merge gadget after
another.  At first there is one state that every byte token leaves and re-enters.  The gadget of a merge
``(u, v) -> w`` copies the state that ``u`` leads to, takes the arc ``v`` out of the copy, lets ``u`` lead to the
copy, and gives every state that has an arc ``u`` an arc ``w`` to the place where ``v`` led.  The paths of the
finished automaton are exactly the token sequences that the merges produce, so among all ways to cut a word, or a prefix
of one, into vocabulary entries just one is a path.  A word is encoded by one pass over its bytes: each position has the
state that its prefix reached, and the transition table says where the tokens that start there lead.  Entries of the
table are filled when they are first needed and then only looked up.  Decoding emits the byte label of every arc.

Null texts count as empty.  Special tokens that occur in a text are emitted as such, as the library does.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tickloom.llm.common import small

#: The pre-split rule of this tokenizer family (fixed value).
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Encoded words, and arcs, that a worker remembers before it starts afresh (about 100 MB each).
REMEMBERED, TABLE_ROWS = 500_000, 700_000
#: Characters of a word that is not remembered.
LONG_WORD = 256


def default_path() -> str:
    """The vocabulary file; ``TICKLOOM_TOKENIZERS`` names another folder."""
    folder = os.environ.get("TICKLOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, "byte_bpe_50k.json")
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bytes_of_chars() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Words(dict):
    """Words met so far with their ids; a new one is encoded."""

    def __init__(self, automaton: TokenAutomaton):
        self.automaton = automaton

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self.automaton.encode_word(word.encode("utf-8", "replace"))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= LONG_WORD:
            self[word] = packed
        return packed


class TokenAutomaton:
    """The automaton of one vocabulary file, with a byte trie for its arc labels."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        to_byte = bytes_of_chars()
        vocab = spec["model"]["vocab"]
        self.labels: dict[int, bytes] = {i: bytes(to_byte[c] for c in s) for s, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.labels |= {i: s.encode() for s, i in self.special.items()}
        # Gadgets.  State 0 is the start; the state s > 0 is state up[s] without the arc cut[s], made at time born[s].
        self.up, self.cut, self.born = [0], [-1], [-1]
        into = {i: 0 for s, i in vocab.items() if len(s) == 1}  # the state that a token leads to
        # Of each token: the left part of its merge, and when it was made; bytes were there from the start.
        self.first, self.time = [-1] * (max(self.labels) + 1), [-2] * (max(self.labels) + 1)
        for k, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            reached, landed = into[u], into[v]
            self.up.append(reached)
            self.cut.append(v)
            self.born.append(k)
            into[u] = len(self.up) - 1
            into[w] = landed
            self.first[w], self.time[w] = u, k
        self.into = into
        self.table: dict[int, int] = {}
        self.trie: dict = {}
        for i in into:
            node = self.trie
            for byte in self.labels[i]:
                node = node.setdefault(byte, {})
            node[-1] = i
        self.split = regex.compile(SPLIT)
        self.words = _Words(self)
        size = max(self.labels) + 1
        joined = [self.labels.get(i, b"") for i in range(size)]
        self.lengths = np.array([len(x) for x in joined], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.flat = np.frombuffer(b"".join(joined), dtype=np.uint8)

    def arc(self, state: int, token: int) -> int:
        """Where ``token`` leads from ``state``, -1 if no arc leaves it: an entry of the transition table, filled on first
        use."""
        q, t, born, time, first, cut, up = state, token, self.born, self.time, self.first, self.cut, self.up
        while q:
            if time[t] >= born[q]:
                t = first[t]  # the arc t was added to q together with, and because of, the arc of its left part
            elif t == cut[q]:
                break
            else:
                q = up[q]
        if len(self.table) >= TABLE_ROWS:
            self.table.clear()
        to = self.table[state << 20 | token] = -1 if q else self.into[token]
        return to

    def encode_word(self, data: bytes) -> list[int]:
        """Token ids of one pre-split word: the one path of the automaton over its bytes.

        Every prefix of a word has one path, so one state is reached at each position.  From it the arcs of the tokens
        that start there lead on, each by a look-up in the transition table; no choice is ever taken back.
        """
        n, table, trie = len(data), self.table, self.trie
        reached, came = [0] * (n + 1), [0] * (n + 1)
        for at in range(n):
            row, node = reached[at] << 20, trie
            for e in range(at, n):
                node = node.get(data[e])
                if node is None:
                    break
                token = node.get(-1)
                if token is not None:
                    to = table.get(row | token)
                    if to is None:
                        to = self.arc(row >> 20, token)
                    if to >= 0:
                        reached[e + 1], came[e + 1] = to, token
        ids = []
        while n:
            ids.append(came[n])
            n -= len(self.labels[came[n]])
        return ids[::-1]

    def encode_plain(self, text: str) -> bytes:
        """Ids of a text without special tokens: pre-split words, looked up or encoded."""
        return b"".join(map(self.words.__getitem__, self.split.findall(text)))

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers; null counts as empty."""
        if not text:
            return b""
        if not any(s in text for s in self.special):
            return self.encode_plain(text)
        out = []
        for part in regex.split("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")", text):
            if part in self.special:
                out.append(np.array([self.special[part]], dtype="<u4").tobytes())
            elif part:
                out.append(self.encode_plain(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The arc labels of ids, joined."""
        a = np.frombuffer(ids, dtype="<u4")
        if not len(a):
            return b""
        lengths = self.lengths[a]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1], dtype=np.int64) + np.repeat(self.starts[a] - (ends - lengths), lengths)
        return self.flat[at].tobytes()


@lru_cache(maxsize=2)
def automaton(path: str) -> TokenAutomaton:
    """The automaton of a file, compiled once in each Python worker."""
    return TokenAutomaton(path)


def clean_utf8(data: bytes) -> bytes:
    """Bytes as the decoder shows them: what is not UTF-8 becomes the replacement character."""
    try:
        data.decode("utf-8")
        return data
    except UnicodeDecodeError:
        return data.decode("utf-8", "replace").encode("utf-8")


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """``id, ids`` for every row; ids: binary, little-endian unsigned 32-bit.  A narrow map, no shuffle.

    Null and empty texts give empty ids; repeated rows stay repeated; other columns are not read.
    """
    path = path or default_path()

    def run(batches):
        a = automaton(path)
        for b in small(batches):
            ids = [a.encode(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, docs[text_col].cast("string")).mapInArrow(run, f"`{id_col}` {kind}, ids binary")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document: encoded, then decoded from the ids.

    One row per input row, null and empty texts included (no tokens, hashes of the empty string).
    """
    path = path or default_path()

    def run(batches):
        a = automaton(path)
        for b in small(batches):
            n, h, d = [], [], []
            for t in b.column(1).to_pylist():
                ids = a.encode(t)
                n.append(len(ids) // 4)
                h.append(hashlib.sha256(ids).hexdigest())
                d.append(hashlib.sha256(clean_utf8(a.decode(ids))).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(h), pa.array(d)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", docs["text"].cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
