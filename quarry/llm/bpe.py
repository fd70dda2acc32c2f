"""BPE encoding and decoding of whole texts, long ones by tree concatenation.

Texts up to ``LONG`` characters are encoded whole: by the tokenizer itself, or
by a faster library over the same vocabulary where both are bound to agree
(``Encoder.ids`` says when). A longer text is cut into parts of equal length
wherever the cuts fall; the parts are encoded on their own, in parallel, and
neighbours are joined pair by pair until one is left. A join is exact, whatever
the cut went through:

* Pre-tokens. The pre-tokenizer reads from left to right and looks a few
  characters ahead, never back, so a start of a pre-token well before the cut
  is one of the whole text's, and from a start that both sides agree on
  everything that follows is the same. A window around the cut, from such a
  start on the left, is split anew and grows until one of its starts is a start
  of the right part too. Pre-tokens between the two are encoded anew.
* Tokens of a long unsplit pre-token. A sequence of tokens is the encoding of
  its text if each two neighbours are that of theirs. Windows of tokens on both
  sides of the cut are encoded anew and grow until their first and last tokens
  are those of the two sides: then every pair of neighbours stands in the left
  part's, the window's or the right part's encoding.

Rounds of joins group two parts at a time by text and place, so a task holds
two halves of one text and nothing else, and each round is written before the
next.

Defined cases. A null text is an empty one and gives no tokens. Rows with equal
ids or texts are encoded each on its own. An empty table gives an empty result.
Added tokens in a text are found as the tokenizer finds them. Other columns
come through, whatever their names.

The tokenizer is one with byte-level pre-tokens, BPE merges without dropout,
and added tokens without options; its file is read by the driver and sent to
the tasks, which need no file of their own.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm.tables import cut

LONG = 1 << 16          # characters of a text that is encoded whole
PIECE = 1 << 15         # characters of a part, at most
UNSPLIT = 1 << 12       # characters of a pre-token that is joined by tokens
WINDOW = 64             # characters on each side of a cut that are looked at first
RUN = 300               # longer runs without or of blanks are the tokenizer's: the faster library's time grows with their square
_BLANKS = re.compile(rf"\s{{{RUN + 1}}}")
# Fixed value: the pattern of byte-level pre-tokens.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 itself, the others from U+0100 on, in order."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(0x100 + others.index(b)) for b in range(256)]


def _loaded(data: bytes) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"          # Spark runs a task for each core
    tok = Tokenizer.from_buffer(data)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _class(tables: Any, c: str) -> str:
    """What the pattern tells apart: letter, number, blank or other; unknown for what is not assigned or a rare blank."""
    if c in " \t\n\r\x0b\x0c\xa0":
        return "blank"
    kind = tables.category(c)
    return {"L": "letter", "N": "number", "P": "other", "S": "other", "M": "other"}.get(kind[0], "unknown")


def _same_vocabulary(tok: dict) -> tiktoken.Encoding | None:
    """The faster library over the tokenizer's tokens; None if their order is not that of the merges or their
    pre-tokens are not the byte-level ones."""
    vocab, byte = tok["model"]["vocab"], {c: b for b, c in enumerate(byte_alphabet())}
    pairs = (m if isinstance(m, list) else m.split(" ") for m in tok["model"]["merges"])
    ranks = [vocab["".join(p)] for p in pairs]
    byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    if tok["pre_tokenizer"] != byte_level or ranks != sorted(set(ranks)) or len(ranks) + 256 != len(vocab):
        return None
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, special_tokens={},
                             mergeable_ranks={bytes(byte[c] for c in t): i for t, i in vocab.items()})


class Part:
    """A text's pre-tokens (their lengths in characters and their numbers of tokens) and token ids."""

    def __init__(self, text: str, lengths: list[int], counts: list[int], ids: list[int]):
        self.text, self.lengths, self.counts, self.ids = text, lengths, counts, ids


class Encoder:
    """Pre-tokens and tokens of parts of texts, and their joins."""

    def __init__(self, data: bytes):
        self.tok = _loaded(data)
        added = json.loads(data)["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens with options do not split a text where they stand")
        self.added = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.split_at = re.compile("|".join(map(re.escape, longest_first))) if added else None
        self.margin = 4 + max(map(len, self.added), default=0)      # characters a pre-token's end may depend on
        self.alike: set[str] = set()            # characters that every engine sees alike
        self.fast = _same_vocabulary(json.loads(data))

    def _word_ids(self, mapped: str) -> tuple[int, ...]:
        return tuple(t.id for t in self.tok.model.tokenize(mapped))

    def word(self, mapped: str) -> tuple[int, ...]:
        """Tokens of one pre-token, given in the byte-level alphabet."""
        return self._word_ids(mapped)

    def ids(self, text: str) -> np.ndarray:
        """The tokens of a whole text.

        The faster library runs the same pattern and merges by the same ranks.
        Their engines agree on characters whose class has not changed since
        Unicode 3.2. It joins two tokens whenever their text is a token, the
        tokenizer only where that pair is a listed merge; but when a token's
        turn comes, its text can only stand there as its own merge's two parts:
        two neighbours are a state of the merging if they are one on their own,
        and that state is unique. Texts with other characters, added tokens or
        very long runs go to the tokenizer.
        """
        new = set(text) - self.alike
        if new:
            self.alike.update(c for c in new if _class(unicodedata, c) == _class(unicodedata.ucd_3_2_0, c) != "unknown")
        words = list(map(len, text.split()))
        # blanks that a run could be made of, if one stands between any two words
        spare = len(text) - sum(words) - max(0, len(words) - 1)
        if (self.fast is None or not new <= self.alike or self.split_at and self.split_at.search(text)
                or max(words, default=0) > RUN or spare >= RUN and _BLANKS.search(text)):
            return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype=np.int32)
        return self.fast.encode_to_numpy(text).astype(np.int32)

    def scan(self, text: str) -> Iterator[tuple[int, int, str | int]]:
        """(start, end, pre-token in the byte-level alphabet or an added token's id)."""
        at = 0
        found = self.split_at.finditer(text) if self.split_at else ()
        for m in found:
            yield from self._plain(text[at:m.start()], at)
            yield m.start(), m.end(), self.added[m.group()]
            at = m.end()
        yield from self._plain(text[at:], at)

    def _plain(self, text: str, base: int) -> Iterator[tuple[int, int, str]]:
        if text:
            for mapped, (s, e) in self.tok.pre_tokenizer.pre_tokenize_str(text):
                yield base + s, base + e, mapped

    def encode(self, text: str) -> Part:
        out = Part(text, [], [], [])
        for s, e, word in self.scan(text):
            self._add(out, e - s, (word,) if isinstance(word, int) else self.word(word))
        return out

    @staticmethod
    def _add(part: Part, length: int, ids: tuple[int, ...] | list[int]) -> None:
        part.lengths.append(length)
        part.counts.append(len(ids))
        part.ids.extend(ids)

    def join(self, left: Part, right: Part, window: int = WINDOW) -> Part:
        """The part of both texts together."""
        if not left.text or not right.text:
            return right if not left.text else left
        cut_at, span = len(left.text), window
        while True:
            # the last start of the left side that is at least a margin and a window before the cut
            k, a, tokens = len(left.lengths), cut_at, len(left.ids)
            while k and a > cut_at - max(span, self.margin):
                k -= 1
                a -= left.lengths[k]
                tokens -= left.counts[k]
            b = min(len(right.text), span)
            fixed = b if b == len(right.text) else b - self.margin  # further on, the window's end may mislead
            starts = {0: (0, 0)} if fixed >= 0 else {}
            at = n = 0
            for j, (length, count) in enumerate(zip(right.lengths, right.counts)):
                at, n = at + length, n + count
                if at > fixed:
                    break
                starts[at] = (j + 1, n)
            words = list(self.scan(left.text[a:] + right.text[:b]))
            agreed = next((i for i, (_, e, _) in enumerate(words) if e >= cut_at - a and e - (cut_at - a) in starts), None)
            if agreed is not None:
                break
            span *= 2
        out = Part(left.text + right.text, left.lengths[:k], left.counts[:k], left.ids[:tokens])
        for s, e, word in words[:agreed + 1]:
            if isinstance(word, int):
                ids: tuple[int, ...] | list[int] = (word,)
            elif (e - s > UNSPLIT and s < cut_at - a < e and left.lengths and s + left.lengths[-1] == cut_at - a
                    and e - (cut_at - a) == right.lengths[0] and {left.ids[-1], right.ids[0]}.isdisjoint(self.added.values())):
                # the left part's last one and the right part's first
                ids = self.join_tokens(left.ids[len(left.ids) - left.counts[-1]:], right.ids[:right.counts[0]])
            else:
                ids = self.word(word)
            self._add(out, e - s, ids)
        j, n = starts[words[agreed][1] - (cut_at - a)]
        out.lengths += right.lengths[j:]
        out.counts += right.counts[j:]
        out.ids += right.ids[n:]
        return out

    def join_tokens(self, left: list[int], right: list[int], window: int = 8) -> list[int]:
        """The tokens of one pre-token, given those of its two sides."""
        spell = self.tok.id_to_token
        before = after = window
        while True:
            i, j = max(0, len(left) - before), min(len(right), after)
            middle = self._word_ids("".join(map(spell, left[i:])) + "".join(map(spell, right[:j])))
            left_agrees = i == 0 or middle[0] == left[i]
            right_agrees = j == len(right) or middle[-1] == right[j - 1]
            if left_agrees and right_agrees:
                return [*left[:i], *middle, *right[j:]]
            before, after = before * (1 if left_agrees else 2), after * (1 if right_agrees else 2)


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer's file (a few megabytes, whatever the input) for the tasks."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


_PART = "r bigint, part int, {kinds}text string, lengths array<int>, counts array<int>, ids array<int>"


def encode(docs: DataFrame, text_col: str, vocab: Broadcast, name: str = "ids", long: int = LONG, piece: int = PIECE) -> DataFrame:
    """The rows' other columns with ``name``, the token ids of the whole text.

    Runs jobs if texts are longer than ``long`` characters: one that cuts them
    and a round for each doubling of the longest.
    """
    others = [c for c in docs.columns if c != text_col]
    src = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    fields = src.schema.fields[:-1]
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in fields)
    names = [f.name for f in fields]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(vocab.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for i in range(0, len(texts), 256):
                run = [enc.ids(t) for t in texts.slice(i, 256).to_pylist()]
                ends = np.cumsum([0, *map(len, run)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(run)))
                yield pa.RecordBatch.from_arrays([*(c.slice(i, 256) for c in batch.columns[:-1]), ids], names=[*names, "ids"])

    short = src.where(F.length("text") <= long).mapInArrow(whole, f"{kinds}ids array<int>")
    at = src.where(F.length("text") > long).withColumn("r", F.monotonically_increasing_id())
    parts = cut(at.mapInArrow(_cutter(names, piece), _PART.format(kinds=kinds)), "bpe-parts")
    most = parts.agg(F.max("part")).first()[0]
    if most is None:
        return short.toDF(*others, name)
    # the parts' texts are dealt out to be encoded, one part at a time; each later round joins two neighbours
    step = parts.groupBy("r", "part").applyInArrow(_joiner(names, vocab), _PART.format(kinds=kinds))
    while most:
        step = cut(step, "bpe-join").groupBy("r", F.expr("part div 2").alias("pair")).applyInArrow(
            _joiner(names, vocab), _PART.format(kinds=kinds))
        most //= 2
    return short.unionByName(cut(step, "bpe-long").select(*names, "ids")).toDF(*others, name)


def _cutter(names: list[str], piece: int):
    """Rows of long texts as rows of parts without tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = dict(zip([*names, "text", "r"], batch.columns))
            for i in range(len(batch)):
                text = cols["text"][i].as_py()
                n = -(-len(text) // piece)
                pieces = [text[len(text) * k // n:len(text) * (k + 1) // n] for k in range(n)]
                own = [pa.concat_arrays([cols[c].slice(i, 1)] * n) for c in names]
                none = pa.nulls(n, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([cols["r"].slice(i, 1)] * n), pa.array(range(n), pa.int32()), *own, pa.array(pieces, pa.string()),
                     none, none, none], names=["r", "part", *names, "text", "lengths", "counts", "ids"])
    return run


def _joiner(names: list[str], vocab: Broadcast):
    """One part without tokens: encoded. Else one or two neighbours: joined, at half their place."""
    made_once: list[Encoder] = []                           # one for all groups of a task

    def run(table: pa.Table) -> pa.Table:
        if not made_once:
            made_once.append(Encoder(vocab.value))
        enc = made_once[0]
        rows = table.select(["part", "text", "lengths", "counts", "ids"]).to_pylist()
        rows.sort(key=lambda r: r["part"])
        if rows[0]["ids"] is None:
            made, place = enc.encode(rows[0]["text"]), rows[0]["part"]
        else:
            sides = [Part(r["text"], r["lengths"], r["counts"], r["ids"]) for r in rows]
            made, place = (enc.join(*sides) if len(sides) == 2 else sides[0]), rows[0]["part"] // 2
        ints = pa.list_(pa.int32())
        first = table.slice(0, 1)
        return pa.table([first["r"], pa.array([place], pa.int32()), *(first[c] for c in names), pa.array([made.text], pa.string()),
                         pa.array([made.lengths], ints), pa.array([made.counts], ints), pa.array([made.ids], ints)],
                        names=["r", "part", *names, "text", "lengths", "counts", "ids"])
    return run


class Decoder:
    """The bytes of every token id; an id that is none has none, as for the tokenizer."""

    def __init__(self, data: bytes):
        tok = json.loads(data)
        byte = {c: b for b, c in enumerate(byte_alphabet())}
        spell = {i: bytes(byte[c] for c in t) for t, i in tok["model"]["vocab"].items()}
        spell.update({t["id"]: t["content"].encode() for t in tok["added_tokens"]})
        by_id = [spell.get(i, b"") for i in range(max(spell, default=-1) + 2)]       # the last one stands for all that are none
        self.width = np.array(list(map(len, by_id)), dtype=np.int64)
        self.begin = np.cumsum(self.width) - self.width
        self.bytes = np.frombuffer(b"".join(by_id), dtype=np.uint8)

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The texts of ``ids[ends[i]:ends[i + 1]]``; bytes that are no text become U+FFFD."""
        none = len(self.width) - 1
        ids = np.where((ids >= 0) & (ids < none), ids, none).astype(np.int64)
        width = self.width[ids]
        after = np.concatenate([[0], np.cumsum(width)])
        at = np.arange(after[-1]) + np.repeat(self.begin[ids] - after[:-1], width)
        whole, edge = self.bytes[at].tobytes(), after[ends]
        try:
            whole.decode()
            first = np.frombuffer(whole, dtype=np.uint8)[edge[:-1][edge[:-1] < len(whole)]]
            sound = not np.any((first & 0xC0) == 0x80)      # and no character is cut between two texts
        except UnicodeDecodeError:
            sound = False
        if sound:
            return pa.Array.from_buffers(pa.large_string(), len(edge) - 1, [None, pa.py_buffer(edge.astype(np.int64)), pa.py_buffer(whole)]).cast(pa.string())
        return pa.array([whole[a:b].decode("utf-8", "replace") for a, b in zip(edge[:-1], edge[1:])], pa.string())


def decode(rows: DataFrame, ids_col: str, vocab: Broadcast, name: str = "decoded") -> DataFrame:
    """The rows' other columns with ``name``, the text of the ids, added tokens included; null ids give an empty text."""
    others = [c for c in rows.columns if c != ids_col]
    src = rows.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], F.col(f"`{ids_col}`").alias("ids"))
    names = [f"c{i}" for i in range(len(others))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(vocab.value)
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            for i in range(0, len(column), 256):
                ids = column.slice(i, 256)
                ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
                texts = decoder.texts(ids.flatten().to_numpy(zero_copy_only=False), ends)
                yield pa.RecordBatch.from_arrays([*(c.slice(i, 256) for c in batch.columns[:-1]), texts], names=[*names, "decoded"])

    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in src.schema.fields[:-1])
    return src.mapInArrow(run, f"{kinds}decoded string").toDF(*others, name)
