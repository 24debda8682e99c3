"""Byte-level BPE encoding and decoding through distinct-word tables (operator 6).

Texts are split into the tokenizer's words; a task keeps a table of the distinct words that it has
met, encodes each of them once (all new ones of a block side by side, see ``wordbpe``), and joins the ids
back by position; decoding joins each id to its
piece in an id-to-piece table. The table lives as long as its task and is bounded
(``TABLE_WORDS``): when it is full a new one begins, which costs time, not correctness.

A table per task, not one for the whole corpus: joining 170 million word positions back through one
global table would shuffle several times the input (figures in the README).

Nulls: a null text is empty and has no ids; ids of rows may be null or repeat. An empty table gives
an empty result; further columns are ignored. Texts with characters beyond the plain repertoire of
``wordbpe`` are split by the tokenizers library, and texts that hold a special token's string are
encoded by it whole, as it does itself.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import column, map_texts
from casebook.llm.wordbpe import LONGEST, Merger, byte_symbols

TABLE_WORDS = 600_000
ENCODE_BATCH = 100_000

# The published pre-tokenization pattern, its Unicode classes written out for code points below 250 hex.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", " \t\n\r\x0b\x0c\xa0"
_WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_ODD = re.compile("[^\x00-\x1b\x20-\x84\x86-ɏ]")


class ByteBpe:
    """``table``: word -> (ids as decimal text, number of ids, decoded bytes)."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        self.merger = Merger(json.loads(source))
        self.library = Tokenizer.from_str(source)
        self.library.no_padding()
        self.library.no_truncation()
        specials = {t.content: i for i, t in self.library.get_added_tokens_decoder().items()}
        self.special = re.compile("|".join(map(re.escape, specials)) or "(?!)")
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.pieces: dict[int, bytes] = {
            i: (s.encode() if s in specials else bytes(byte_of[c] for c in s)) for s, i in self.library.get_vocab(with_added_tokens=True).items()}
        self.table: dict[str, tuple[str, int, bytes]] = {}

    def split(self, text: str) -> list[str]:
        if not _ODD.search(text):
            return _WORD.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def entry(self, ids: list[int]) -> tuple[str, int, bytes]:
        return ",".join(map(str, ids)), len(ids), b"".join([self.pieces[i] for i in ids])

    def learn(self, words: set[str]) -> None:
        """Encodes the words that the table does not hold."""
        new = words - self.table.keys()
        if len(self.table) + len(new) > TABLE_WORDS:
            self.table.clear()
            new = words
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for word in new:
            data = word.encode()
            by_width.setdefault(len(data), []).append((word, data))
        for width, some in by_width.items():
            if width > LONGEST:
                for word, _ in some:
                    self.table[word] = self.entry(self.library.encode(word, add_special_tokens=False).ids)
                continue
            for at in range(0, len(some), ENCODE_BATCH):
                part = some[at:at + ENCODE_BATCH]
                data = np.frombuffer(b"".join([d for _, d in part]), dtype=np.uint8).reshape(len(part), width)
                ids, counts = self.merger.merge_all(self.merger.symbols(data))
                for (word, _), row, n in zip(part, ids.tolist(), counts.tolist()):
                    self.table[word] = self.entry(row[:n])

    def encode(self, texts: list[str]) -> Iterator[tuple[str, int, bytes]]:
        """For each text its ids as comma-joined decimals, their number, and the decoded bytes."""
        whole = {i for i, t in enumerate(texts) if self.special.search(t)}
        split = [[] if i in whole else self.split(t) for i, t in enumerate(texts)]
        self.learn(set().union(*split))
        get = self.table.__getitem__
        for i, words in enumerate(split):
            if i in whole:
                yield self.entry(self.library.encode(texts[i], add_special_tokens=False).ids)
            elif words:
                ids, counts, decoded = zip(*map(get, words))
                yield ",".join(ids), sum(counts), b"".join(decoded)
            else:
                yield "", 0, b""


def encode_documents(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Contract rows: doc_id, n_tokens, ids_sha256, decoded_sha256. ``tokenizer`` is the JSON text of a
    tokenizer file."""
    def per_task():
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        bpe = ByteBpe(tokenizer)

        def run(batch: pa.RecordBatch) -> pa.Table:
            n, ids, decoded = [], [], []
            for text, count, data in bpe.encode(column(batch, "text").to_pylist()):
                n.append(count)
                ids.append(hashlib.sha256(text.encode()).hexdigest())
                decoded.append(hashlib.sha256(data.decode("utf-8", "replace").encode()).hexdigest())
            return pa.table({"doc_id": column(batch, "doc_id"), "n_tokens": pa.array(n, pa.int64()),
                             "ids_sha256": pa.array(ids, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())})

        return run

    body = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_texts(body, per_task, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", per_task=True)
