"""Exact merge-type (BPE) SentencePiece encoding by backtracking, and decoding.

A sequence of pieces is what merging gives exactly if it spells the text and every two adjacent
pieces are compatible: merging their joint spelling anew gives the same two.  So a word is
encoded from left to right: Aho-Corasick finds all pieces that start at each position, the longest is tried first, a
piece is taken if it is compatible with the one before and its end is not marked as failed;
where none is left the position is marked in a bitfield of failed positions and the last piece
is taken back.  Compatibility is decided by re-merging, once per pair of pieces.

Texts are cut where no piece of the vocabulary can span: before a run of spaces (checked: no piece holds
one after another character), around line breaks, and between a letter and a character that no
piece holds next to a letter.  Each distinct unit of a slice is encoded once while a worker keeps it.
Characters outside the vocabulary become byte pieces.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from sluice.llm.textcols import CodedWords, WordTable, slices, texts_of

_SPACE = "▁"
_CUT = "\x00"


class PieceModel:
    """Encoder and decoder of one SentencePiece BPE model file."""

    _loaded: dict[str, "PieceModel"] = {}

    @classmethod
    def load(cls, path: str) -> "PieceModel":
        """One model per worker process and file."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = proto.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        norm, train = spec.normalizer_spec, spec.trainer_spec
        if (train.model_type != train.BPE or norm.precompiled_charsmap or norm.remove_extra_whitespaces
                or not norm.add_dummy_prefix or not norm.escape_whitespaces or not train.byte_fallback
                or train.treat_whitespace_as_suffix):
            raise ValueError("only BPE models with identity normalization and byte fallback")
        size = library.get_piece_size()
        self.spelling: dict[int, str] = {}
        self.byte_id: dict[int, int] = {}
        self.surface: list[bytes] = []
        for i in range(size):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.surface.append(bytes([int(piece[1:-1], 16)]))
            elif library.is_control(i):
                self.surface.append(b"")
            elif library.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            elif library.is_unused(i) or spec.pieces[i].type == 4:  # user-defined
                raise ValueError("unused and user-defined pieces are not supported")
            else:
                self.spelling[i] = piece.replace(_SPACE, " ")
                self.surface.append(self.spelling[i].encode())
        self.end_id = library.eos_id()
        self.id_of = {s: i for i, s in self.spelling.items()}
        self.score = {s: library.get_score(i) for s, i in self.id_of.items()}
        self.chars = {c for s in self.id_of for c in s}
        if "\n" in self.chars or any(re.search("[^ ] ", s) for s in self.id_of):
            raise ValueError("a piece spans a line break, or a space after another character")
        # characters that stand after / before a letter in some piece: no cut there
        self.after = {b for s in self.id_of for a, b in zip(s, s[1:]) if a.isalpha() and not b.isalpha()}
        self.before = {a for s in self.id_of for a, b in zip(s, s[1:]) if b.isalpha() and not a.isalpha()}
        self.automaton = ahocorasick.Automaton()
        for s, i in self.id_of.items():
            self.automaton.add_word(s, (len(s), i))
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.parts = WordTable(self._encode_part, limit=100_000)
        self.units = WordTable(self._encode_unit, limit=125_000)

    def merged(self, text: str) -> list[str]:
        """Plain merging: the best-scored adjacent pair first, the leftmost of equals."""
        parts = list(text)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the two pieces' joint spelling gives just these two."""
        found = self.fits.get((a, b))
        if found is None:
            if len(self.fits) > 200_000:  # bounded like the tables of words
                self.fits.clear()
            x, y = self.spelling[a], self.spelling[b]
            found = self.fits[a, b] = self.merged(x + y) == [x, y]
        return found

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text whose characters are all in the vocabulary."""
        n = len(text)
        starts: list[list[tuple[int, int]]] = [[] for _ in range(n)]  # (length, id), ascending
        for end, (length, i) in self.automaton.iter(text):
            starts[end - length + 1].append((length, i))
        failed = 0  # bit p: no encoding goes on from position p
        taken: list[tuple[int, int]] = []  # (position, index into starts[position])
        pos, index = 0, -1
        while pos < n:
            options = starts[pos]
            if index < 0:
                index = len(options)
            last = starts[taken[-1][0]][taken[-1][1]][1] if taken else None
            while index:
                index -= 1
                length, i = options[index]
                if not failed >> (pos + length) & 1 and (last is None or self.compatible(last, i)):
                    taken.append((pos, index))
                    pos, index = pos + length, -1
                    break
            else:
                if not taken:
                    raise ValueError("no exact encoding")
                failed |= 1 << pos
                pos, index = taken.pop()
        return [starts[p][k][1] for p, k in taken]

    def _encode_part(self, part: str) -> bytes:
        ids: list[int] = []
        run = ""
        for c in part:
            if c in self.chars:
                run += c
                continue
            if run:
                ids += self.backtrack(run)
                run = ""
            ids += [self.byte_id[b] for b in c.encode()]
        if run:
            ids += self.backtrack(run)
        return array("I", ids).tobytes()

    def _encode_unit(self, unit: str) -> bytes:
        cuts, at = [], 0
        for i in range(1, len(unit)):
            a, b = unit[i - 1], unit[i]
            if (a.isalpha() and not b.isalpha() and b not in self.after) or \
                    (b.isalpha() and not a.isalpha() and a != " " and a not in self.before):
                cuts.append(unit[at:i])
                at = i
        return b"".join(self.parts([*cuts, unit[at:]])) if cuts else self._encode_part(unit)

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after each other (uint32, no end ids) and their offsets by text."""
        texts = texts_of(texts)
        spelled = pc.replace_substring(pc.binary_join_element_wise(" ", texts, ""), _SPACE, " ")
        spelled = pc.if_else(pc.equal(texts, ""), "", spelled)
        odd = pc.match_substring(texts, _CUT)
        lines = pc.replace_substring(spelled, "\n", f"{_CUT}\n{_CUT}")
        runs = pc.match_substring(lines, "  ")
        cut = pc.if_else(runs, pc.replace_substring_regex(pc.if_else(runs, lines, ""), " +", f"{_CUT}\\0"),
                         pc.replace_substring(lines, " ", f"{_CUT} "))
        if pc.any(odd).as_py():  # a text holds the mark itself: cut it by hand
            rows = [[u for u in re.findall(r" +[^ \n]*|[^ \n]+|\n", s)] if o else [u for u in c.split(_CUT)]
                    for s, c, o in zip(spelled.to_pylist(), cut.to_pylist(), odd.to_pylist())]
            lists = pa.array(rows, pa.list_(pa.string()))
        else:
            lists = pc.split_pattern(cut, _CUT)
        words = CodedWords(lists)
        uniq = words.strings()
        values = self.units([u for u in uniq if u])
        if "" in uniq:
            values.insert(uniq.index(""), b"")
        return words.gather(values)

    def decode(self, ids: list[int]) -> str:
        """Text of a sequence of ids; the space that encoding puts first goes."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


def code_pieces(docs: DataFrame, model: str, end_id: bool = True) -> DataFrame:
    """The columns of ``docs`` (but own ones of these names) plus ``ids`` (array<int>): the pieces of ``text``, then
    the end id if asked for, and ``decoded``: the text that these ids decode to.  A null text counts as
    empty.  One pass, so that a task needs one worker."""
    mine = ("ids", "decoded")
    docs = docs.select(*[c for c in docs.columns if c.lower() not in mine])
    names = docs.columns
    at = next(i for i, c in enumerate(names) if c.lower() == "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceModel.load(model)
        for whole in batches:
            for batch in slices(whole, at, 4 << 20):
                ids, ends = coder.encode_column(batch.column(at))
                if end_id:
                    ids = np.insert(ids, ends[1:], coder.end_id)
                    ends = ends + np.arange(len(ends))
                cuts = ends.tolist()
                decoded = [coder.decode(ids[a:b].tolist()) for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(ends.astype(np.int32), ids.astype(np.int32)),
                     pa.array(decoded, pa.string())], names=[*names, *mine])

    return docs.mapInArrow(run, T.StructType([
        *docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType())]))
