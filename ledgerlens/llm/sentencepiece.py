"""SentencePiece encoding and decoding: a piece automaton drives a Viterbi pass.

An Aho-Corasick automaton over all pieces reads a text once. At each position
the output links list every piece that ends there, and each relaxes the best
score of that position from the score where the piece starts. A character that is
no piece by itself costs UNKNOWN_PENALTY below the lowest score and becomes byte
pieces (or the unknown piece, if the model has no bytes). Scores add up; the
best sum wins, and of equal sums the longer last piece.

As in the model's own rules, a space is written as the meta symbol and one is put
before the text (`add_dummy_prefix`). A meta symbol that stands in a text
is spelled in bytes, so decoding gives back every text exactly.

No piece holds a line break or a meta symbol after another character, so the
best path of a text is that of its runs (meta symbols and what follows up to the
next, line breaks apart). The runs of a part of a column are cut at once, and each distinct one is
encoded, and decoded again for the check, a single time; ids are then taken by run. Distinct runs
go through the automaton side by side, a character of each at a time.

Null texts have no ids (null), empty ones an empty list. Repeated rows are
encoded each for itself.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.batches import map_batches

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
META = "▁"
UNKNOWN_PENALTY = 10.0
PART_BYTES = 1 << 22  # of text whose runs are coded together
SIDE_BY_SIDE = 1 << 20  # runs times letters of the longest
FEW = 16  # so few runs go through one by one
DENSE = 128  # letters whose transitions are tabulated for every node


@dataclass(frozen=True)
class Vocabulary:
    """Pieces by id. `kinds`: n(ormal), b(yte), u(nknown), c(ontrol). Small: sent along with each task."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: str
    dummy_prefix: bool = True


def read_vocabulary(path: str = MODEL_PATH) -> Vocabulary:
    """Read a model file on the driver."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    kind = lambda i: "u" if model.is_unknown(i) else "b" if model.is_byte(i) else "c" if model.is_control(i) or model.is_unused(i) else "n"
    pieces = tuple(model.id_to_piece(i) for i in ids)
    prefix = model.encode("a") != [model.piece_to_id("a")]
    return Vocabulary(pieces, tuple(model.get_score(i) for i in ids), "".join(map(kind, ids)), prefix)


class Automaton:
    """Trie with failure and output links over the normal pieces."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        scores, kinds = vocabulary.scores, vocabulary.kinds
        normal = [i for i, kind in enumerate(kinds) if kind == "n" and vocabulary.pieces[i]]
        self.next: list[dict[str, int]] = [{}]
        self.piece: list[int] = [-1]
        for i in normal:
            node = 0
            for letter in vocabulary.pieces[i]:
                node = self.next[node].setdefault(letter, len(self.next))
                if node == len(self.next):
                    self.next.append({})
                    self.piece.append(-1)
            self.piece[node] = i
        self.fail = [0] * len(self.next)
        self.link = [0] * len(self.next)  # the next shorter suffix that is a piece, 0 for none
        waiting = deque(self.next[0].values())
        while waiting:
            node = waiting.popleft()
            for letter, child in self.next[node].items():
                fail = self.fail[node]
                while fail and letter not in self.next[fail]:
                    fail = self.fail[fail]
                self.fail[child] = self.next[fail].get(letter, 0)
                waiting.append(child)
            fail = self.fail[node]
            self.link[node] = fail if self.piece[fail] >= 0 else self.link[fail]
        # all outputs of a node, longest first: its own piece, then along the output links
        self.outputs: list[tuple[tuple[int, float, int], ...]] = [()] * len(self.next)
        for node in range(1, len(self.next)):
            found, at = [], node if self.piece[node] >= 0 else self.link[node]
            while at:
                i = self.piece[at]
                found.append((len(vocabulary.pieces[i]), scores[i], i))
                at = self.link[at]
            self.outputs[node] = tuple(found)
        self.single = {vocabulary.pieces[i] for i in normal if len(vocabulary.pieces[i]) == 1}
        self.bytes = {int(vocabulary.pieces[i][3:5], 16): i for i, kind in enumerate(kinds) if kind == "b"}
        self.unknown = kinds.find("u")
        self.penalty = min((scores[i] for i in normal if scores[i] > -1e8), default=0.0) - UNKNOWN_PENALTY
        inner = any(META in vocabulary.pieces[i].lstrip(META) for i in normal)
        breaks = any("\n" in vocabulary.pieces[i] for i in normal)
        # where no piece crosses: before a meta symbol that follows another character, around line breaks
        self.runs = re.compile(rf"{META}+[^{META}\n]*|\n+|[^{META}\n]+") if not (inner or breaks) else re.compile(r"(?s).+")
        self.splits = not (inner or breaks)
        # what a piece decodes to by itself; None for a byte that is part of a longer character
        alone = {"b": lambda p: chr(int(p[3:5], 16)) if int(p[3:5], 16) < 128 else None, "c": lambda p: ""}
        self.plain = [alone.get(k, lambda p: p.replace(META, " "))(p) for p, k in zip(vocabulary.pieces, kinds)]

        self._tabulate()

    def _tabulate(self) -> None:
        """The automaton as arrays: a full transition table for the DENSE commonest letters, sorted edges for the others."""
        uses = Counter(letter for edges in self.next for letter in edges)
        dense = [letter for letter, _ in sorted(uses.items(), key=lambda u: (-u[1], u[0]))[:DENSE]]
        self.column = np.full(0x110000, -1, np.int32)  # of the table, by code point
        self.column[[ord(letter) for letter in dense]] = np.arange(len(dense))
        self.is_single = np.zeros(0x110000, bool)
        self.is_single[[ord(letter) for letter in self.single]] = True
        self.table = np.zeros((len(self.next), max(1, len(dense))), np.int32)
        self.edges = np.array(sorted(node << 21 | ord(letter) for node, edges in enumerate(self.next) for letter in edges), np.int64)
        self.edge_ends = np.array([self.next[key >> 21][chr(key & 0x1FFFFF)] for key in self.edges.tolist()], np.int32)
        depth = deque([0])
        while depth:  # a node comes after its failure node, whose row it inherits
            node = depth.popleft()
            if node:
                self.table[node] = self.table[self.fail[node]]
            for letter, child in self.next[node].items():
                if (column := self.column[ord(letter)]) >= 0:
                    self.table[node, column] = child
                depth.append(child)
        self.fails, self.pieces_at = np.array(self.fail, np.int32), np.array(self.piece, np.int32)
        self.links = np.array(self.link, np.int32)
        self.first_output = np.where(self.pieces_at >= 0, np.arange(len(self.next)), self.links).astype(np.int32)
        held = np.maximum(self.pieces_at, 0)
        self.lengths = np.array([len(p) for p in self.vocabulary.pieces], np.int32)[held]
        self.scores_at = np.array(self.vocabulary.scores)[held]
        self.plain_column = pa.array(self.plain, pa.string())

    def _steps(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Where each node goes on its letter."""
        columns = self.column[letters]
        after = self.table[nodes, np.maximum(columns, 0)]
        rare = np.flatnonzero(columns < 0)
        after[rare] = 0
        at = nodes[rare]
        while len(rare) and len(self.edges):
            keys = at.astype(np.int64) << 21 | letters[rare]
            places = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
            hit = self.edges[places] == keys
            after[rare[hit]] = self.edge_ends[places[hit]]
            on = ~hit & (at > 0)
            rare, at = rare[on], self.fails[at[on]]
        return after

    def best_paths(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the best segmentation of every run, end to end, and how many each has."""
        order = sorted(range(len(runs)), key=lambda i: len(runs[i]))
        sizes, found, first = np.zeros(len(runs), np.int64), [], 0
        while first < len(order):
            last, rows = first + 1, SIDE_BY_SIDE
            while last < len(order) and (last + 1 - first) * len(runs[order[last]]) <= rows:
                last += 1
            block = np.array(order[first:last])
            if len(block) < FEW:
                alone = [self.best_path(runs[i]) for i in block]
                ids, counts = np.array(list(chain.from_iterable(alone)), np.int32), np.array([len(a) for a in alone])
            else:
                ids, counts = self._block_paths([runs[i] for i in block])
            sizes[block] = counts
            found.append((block, ids, counts))
            first = last
        flat = np.zeros(int(sizes.sum()), np.int32)
        starts = np.cumsum(sizes) - sizes
        for block, ids, counts in found:
            flat[np.repeat(starts[block] - (np.cumsum(counts) - counts), counts) + np.arange(len(ids))] = ids
        return flat, sizes

    def _block_paths(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """`best_paths` of runs in order of length: position by position over all that are that long."""
        n, lengths = len(runs), np.array([len(run) for run in runs])
        letters = np.array(runs).view(np.uint32).reshape(n, -1).T.astype(np.int64)
        best = np.full((lengths[-1] + 1, n), -np.inf)
        best[0] = 0.0
        by = np.full((lengths[-1] + 1, n), -1, np.int32)
        from_ = np.ones((lengths[-1] + 1, n), np.int32)
        nodes = np.zeros(n, np.int32)
        for end in range(1, lengths[-1] + 1):
            a = int(np.searchsorted(lengths, end))
            letter = letters[end - 1, a:]
            nodes[a:] = self._steps(nodes[a:], letter)
            top, rows, at = best[end], np.arange(a, n), self.first_output[nodes[a:]]
            while True:  # along the output links, longest piece first
                on = at > 0
                rows, at = rows[on], at[on]
                if not len(rows):
                    break
                reached = best[end - self.lengths[at], rows] + self.scores_at[at]
                better = reached > top[rows]
                won, by_node = rows[better], at[better]
                top[won], from_[end, won], by[end, won] = reached[better], self.lengths[by_node], self.pieces_at[by_node]
                at = self.links[at]
            unknown = best[end - 1, a:] + self.penalty
            won = a + np.flatnonzero(~self.is_single[letter] & (unknown > top[a:]))
            top[won], from_[end, won], by[end, won] = unknown[won - a], 1, -1
        at, rows, steps = lengths.copy(), np.arange(n), []
        while len(rows):  # back from the ends
            steps.append((rows, by[at[rows], rows], at[rows]))
            at[rows] -= from_[at[rows], rows]
            rows = rows[at[rows] > 0]
        steps.reverse()
        rows, ids, ends = (np.concatenate([s[k] for s in steps]) for k in range(3))
        in_order = np.argsort(rows, kind="stable")
        rows, ids, ends = rows[in_order], ids[in_order], ends[in_order]
        missing = np.flatnonzero(ids < 0)
        if not len(missing):
            return ids, np.bincount(rows, minlength=n)
        spelled = [self.spelled(runs[rows[i]][ends[i] - 1]) for i in missing]
        copies = np.ones(len(ids), np.int64)
        copies[missing] = [len(s) for s in spelled]
        rows, ids, from_missing = np.repeat(rows, copies), np.repeat(ids, copies), np.repeat(ids < 0, copies)
        ids[from_missing] = list(chain.from_iterable(spelled))
        return ids, np.bincount(rows, minlength=n)

    def spelled(self, letter: str) -> list[int]:
        if len(self.bytes) == 256:
            return [self.bytes[b] for b in letter.encode("utf-8", "surrogatepass")]
        return [self.unknown]

    def best_path(self, run: str) -> list[int]:
        """Ids of the segmentation with the best sum of scores."""
        n = len(run)
        best = [0.0] + [float("-inf")] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        node, step, fail, outputs, penalty, single = 0, self.next, self.fail, self.outputs, self.penalty, self.single
        for end in range(1, n + 1):
            letter = run[end - 1]
            after = step[node].get(letter)
            if after is None:
                start = node
                while node and letter not in step[node]:
                    node = fail[node]
                after = step[node].get(letter, 0)
                if letter < "\x80":  # remembered: at most 128 a node
                    step[start][letter] = after
            node = after
            top, from_, by = float("-inf"), 0, -1
            for length, score, piece in outputs[node]:  # longest first
                reached = best[end - length] + score
                if reached > top:
                    top, from_, by = reached, length, piece
            if letter not in single and best[end - 1] + penalty > top:
                top, from_, by = best[end - 1] + penalty, 1, -1
            best[end], back[end] = top, (from_, by)
        ids: list[int] = []
        at = n
        while at:
            length, piece = back[at]
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(reversed(self.spelled(run[at - 1])))
            at -= length
        ids.reverse()
        return ids

    def encode_column(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """`encode` of every text, and whether the ids decode to it; null for null."""
        texts = texts.cast(pa.large_string())
        literal = pc.fill_null(pc.match_substring(texts, META), False)
        plain = pc.if_else(literal, "", pc.fill_null(texts, ""))
        if self.vocabulary.dummy_prefix:
            plain = pc.if_else(pc.equal(plain, ""), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), plain, pa.scalar("", pa.large_string())))
        ids, exact = self._encode_runs(pa.array(plain) if not isinstance(plain, pa.Array) else plain)
        rows = np.arange(len(texts))
        if pc.any(literal).as_py():  # texts with meta symbols of their own, one by one
            marked = np.flatnonzero(literal.to_numpy(zero_copy_only=False))
            coded = [self.encode(texts[int(i)].as_py()) for i in marked]
            right = [self.decode(found) == texts[int(i)].as_py() for i, found in zip(marked, coded)]
            ids = pa.concat_arrays([ids, pa.array(coded, ids.type)])
            exact = pa.concat_arrays([exact, pa.array(right, pa.bool_())])
            rows[marked] = len(texts) + np.arange(len(marked))
        rows = pa.array(rows, mask=texts.is_null().to_numpy(zero_copy_only=False))
        return ids.take(rows), exact.take(rows)

    def _encode_runs(self, texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Texts with their first space and without meta symbols or nulls."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        whole = texts.buffers()[2]
        data = (np.frombuffer(whole, np.uint8) if whole else np.zeros(0, np.uint8))[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets[:-1]] = True
        if self.splits and len(data):
            space, line_end = data == 0x20, data == 0x0A
            begins[1:-1] |= (space[1:] & ~space[:-1]) | (line_end[1:] != line_end[:-1])
        starts = np.flatnonzero(begins[:-1])
        ends = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        runs = pa.LargeStringArray.from_buffers(len(starts), ends, pa.py_buffer(np.ascontiguousarray(data))).dictionary_encode()
        distinct = runs.dictionary
        pieces, sizes = self.best_paths([run.replace(" ", META) for run in distinct.to_pylist()])
        wrong = ~self._decode_to(distinct, pieces, sizes)
        code = runs.indices.to_numpy()
        before = np.concatenate(([0], np.cumsum(sizes[code])))  # ids before each run of the column
        at = np.repeat((np.cumsum(sizes) - sizes)[code] - before[:-1], sizes[code]) + np.arange(before[-1])
        first_run = np.searchsorted(starts, offsets)
        ids = pa.ListArray.from_arrays(pa.array(before[first_run], pa.int32()), pa.array(pieces[at], pa.int32()))
        faults = np.concatenate(([0], np.cumsum(wrong[code])))[first_run]
        return ids, pa.array(faults[1:] == faults[:-1])

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if META in text:  # a meta symbol of the text itself is spelled in bytes
            literal = self.spelled(META)
            parts = text.split(META)
            ids = self._encode((" " if self.vocabulary.dummy_prefix else "") + parts[0])
            for part in parts[1:]:
                ids = ids + literal + self._encode(part)
            return ids
        return self._encode((" " if self.vocabulary.dummy_prefix else "") + text)

    def _encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.best_path, self.runs.findall(text.replace(" ", META)))))

    def _decode_to(self, runs: pa.Array, pieces: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Whether the ids of each run decode to it."""
        ends = np.concatenate(([0], np.cumsum(sizes)))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), self.plain_column.take(pa.array(pieces))), "")
        right = pc.equal(texts, runs.cast(pa.string()))
        same = pc.fill_null(right, False).to_numpy(zero_copy_only=False).copy()
        for i in np.flatnonzero(right.is_null().to_numpy(zero_copy_only=False)):  # a character spelled in several bytes
            same[i] = self.decoded(pieces[ends[i] : ends[i + 1]].tolist()) == runs[int(i)].as_py()
        return same

    def decode(self, ids: list[int]) -> str:
        """Text of the ids, without the put-in space."""
        text = self.decoded(ids)
        return text[1:] if self.vocabulary.dummy_prefix and text.startswith(" ") else text

    def decoded(self, ids: list[int]) -> str:
        """Text of the ids as they are: bytes are joined up."""
        try:
            return "".join(map(self.plain.__getitem__, ids))
        except TypeError:  # a character spelled in several bytes
            pass
        pieces, kinds, parts = self.vocabulary.pieces, self.vocabulary.kinds, []
        spelled = bytearray()
        for i in ids:
            if kinds[i] == "b":
                spelled.append(int(pieces[i][3:5], 16))
                continue
            if spelled:
                parts.append(spelled.decode("utf-8", "replace"))
                spelled = bytearray()
            if kinds[i] != "c":
                parts.append(pieces[i].replace(META, " "))
        if spelled:
            parts.append(spelled.decode("utf-8", "replace"))
        return "".join(parts)


@lru_cache(maxsize=2)
def automaton(vocabulary: Vocabulary) -> Automaton:
    return Automaton(vocabulary)


def encode_texts(df: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: the id, `ids` and `exact`, whether decoding gives back the text."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value)
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
            at = 0
            while at < batch.num_rows:  # parts of about PART_BYTES, or one text
                until = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART_BYTES, "right"))
                part = batch.slice(at, max(1, until - at))
                at += part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), *machine.encode_column(part.column(1))], ["id", "ids", "exact"])

    kept = df.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    found = map_batches(kept, encode, f"id {kept.schema['id'].dataType.simpleString()}, ids array<int>, exact boolean")
    return found.withColumnRenamed("id", id_column)


def decode_ids(df: DataFrame, vocabulary: Vocabulary, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """One row per input row: the id and `text`; null for null ids."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value)
        for batch in batches:
            texts = [None if ids is None else machine.decode(ids) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kept = df.select(F.col(id_column).alias("id"), F.col(ids_column).cast("array<int>").alias("ids"))
    found = map_batches(kept, decode, f"id {kept.schema['id'].dataType.simpleString()}, text string")
    return found.withColumnRenamed("id", id_column)
