"""Exact merge-type (SentencePiece BPE) encoding by backtracking, and decoding.

A merge-type encoder joins, again and again, the adjacent pair whose joined
piece has the best score, the leftmost on ties. Its result is the one token
sequence in which every two neighbours would come out unchanged if their
joined text were merged anew. So no merge queue over the text is needed:

* an Aho-Corasick pass gives the longest piece that starts at each place;
* tokens are taken greedily; a token is kept if it is compatible with the one
  before (their text re-merged gives the same two, remembered by pair);
* if not, the next shorter piece that starts there is tried; if none is left,
  the last token is taken back, and the place is marked in a bitfield of
  places from which no ending exists, so that no place is tried twice.

Characters that are no piece become their UTF-8 byte tokens. A piece never
crosses from a letter to a space mark (checked when the model is read), so a
text is encoded by words, and frequent words are remembered (a bounded table;
it only saves time).

Edge cases: a null text counts as empty; an empty text has the end id only.
Repeated rows give repeated results; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from strata.llm.common import pieces, sha256, text_bytes, texts

MARK = "▁"
_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_REMEMBER = 300_000


class PieceModel:
    """A merge-type model: its pieces, scores and byte tokens."""

    def __init__(self, path: str):
        # The library reads the file; encoding and decoding are ours.
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.end_id, self.unk_id = sp.eos_id(), sp.unk_id()
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        self.ids = {p: i for i, p in enumerate(self.piece) if not special[i]}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.byte_id = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_of = {i: b for b, i in enumerate(self.byte_id)}
        self.shown = ["" if sp.is_control(i) else p.replace(MARK, " ") for i, p in enumerate(self.piece)]
        self.control = frozenset(i for i in range(n) if sp.is_control(i))
        self.shown[self.unk_id] = " ⁇ "
        if self.unk_id != 0:
            raise ValueError("id 0 must be the unknown id")
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("pieces of this model cross from letters to space marks; words can't be encoded one by one")
        # Tokens are numbers below: a piece's id, or minus the code point of a
        # character that is no piece (NUL is 0).
        self.size = [len(p) for p in self.piece]
        self.find = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.find.add_word(p, (i, len(p) - 1))
        self.find.make_automaton()
        # the next shorter piece that a piece starts with
        self.shorter: list[int | None] = [None] * n
        for p, i in self.ids.items():
            self.shorter[i] = next((self.ids[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.ids), None)
        self.number = [str(i) for i in range(n)]
        self._fits: dict[int, bool] = {}
        self._new: dict[str, tuple[int, ...]] = {}
        self._old: dict[str, tuple[int, ...]] = {}

    def merge(self, text: str) -> list[str]:
        """The definition: merge the best pair until none is left."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether token ``a`` then ``b`` stay as they are when re-merged."""
        x, y = (self.piece[t] if t > 0 else chr(-t) for t in (a, b))
        if len(self._fits) >= 2 * _REMEMBER:
            self._fits.clear()
        known = self._fits[a << 32 | b + 0x200000] = self.merge(x + y) == [x, y]
        return known

    def split(self, word: str) -> list[int]:
        """The tokens of one word, by backtracking."""
        n = len(word)
        longest = [0] * n  # 0 is the unknown id, which no piece has
        for end, (i, more) in self.find.iter(word):
            longest[end - more] = i  # later ends are longer pieces
        size, fitting = self.size, self._fits
        open_ = -1  # a cleared bit: no ending from this place
        out: list[int] = []
        at, last = 0, None
        token = longest[0] or -ord(word[0])
        while True:
            end = at + (size[token] if token > 0 else 1)
            if open_ >> end & 1:
                ok = last is None or fitting.get(last << 32 | token + 0x200000)
                if ok or ok is None and self.fits(last, token):
                    out.append(token)
                    if end == n:
                        return out
                    at, last = end, token
                    token = longest[at] or -ord(word[at])
                    continue
            shorter = self.shorter[token] if token > 0 else None
            if shorter is not None:
                token = shorter
                continue
            open_ &= ~(1 << at)
            token = out.pop()
            last = out[-1] if out else None
            at -= size[token] if token > 0 else 1

    def encode_word(self, word: str) -> tuple[int, ...]:
        out = self.split(word)
        if min(out) <= 0:
            out = [i for t in out for i in ((t,) if t > 0 else [self.byte_id[b] for b in chr(-t).encode("utf-8", "replace")])]
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        """All ids of a text, without the end id."""
        if not text:
            return []
        new, old, out = self._new, self._old, []
        for w in _WORDS.findall(MARK + text.replace(" ", MARK)):
            ids = new.get(w)
            if ids is None:
                ids = old.get(w)
                if ids is None:
                    ids = self.encode_word(w)
                if len(w) <= 64:
                    if len(new) >= _REMEMBER:
                        self._old, self._new = new, {}
                        new, old = self._new, self._old
                    new[w] = ids
            out.append(ids)
        return list(chain.from_iterable(out))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: marks become spaces, the first one is dropped,
        byte runs are read as UTF-8, each bad byte as U+FFFD."""
        shown = self.shown
        if self.byte_of.keys().isdisjoint(ids):
            text = "".join([shown[i] for i in ids])
        else:
            out: list[str] = []
            run = bytearray()
            for i in ids:
                b = self.byte_of.get(i)
                if b is not None:
                    run.append(b)
                    continue
                if run:
                    out.append(_bytes(run))
                    run = bytearray()
                out.append(shown[i])
            if run:
                out.append(_bytes(run))
            text = "".join(out)
        first = next((i for i in ids if i not in self.control), None)
        return text[1:] if first is not None and first not in self.byte_of and self.piece[first].startswith(MARK) else text


def _bytes(run: bytearray) -> str:
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(run):
            for n in (1, 2, 3, 4):
                try:
                    out.append(run[i : i + n].decode("utf-8"))
                    i += n
                    break
                except UnicodeDecodeError:
                    pass
            else:
                out.append("�")
                i += 1
        return "".join(out)


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """One model a worker process; ``path`` is there on every executor."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encoded(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ``ids`` (with the end id) and ``decoded``, the text of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for b in pieces(batches):
            ids = [[*m.encode(t), m.end_id] for t in texts(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([m.decode(x) for x in ids], pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    return text_bytes(df, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        number = m.number
        for b in pieces(batches):
            n, a, d = [], [], []
            for t in texts(b.column("text")):
                ids = [*m.encode(t), m.end_id]
                n.append(len(ids))
                a.append(sha256(" ".join([number[i] for i in ids])))
                d.append(sha256(m.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(d, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return text_bytes(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
