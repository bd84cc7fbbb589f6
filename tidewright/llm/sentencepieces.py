"""SentencePiece BPE encoding and decoding through a prefix table.

A merge-type vocabulary encodes every prefix of a text to pieces whose last one is unique. The
table stores that last piece for each prefix: an automaton lists the pieces that end at a position,
and the one is taken that may follow the last piece of the prefix before it. Two pieces may stand side
by side when merging their joined text gives just those two, a test that is run once for each pair and
kept. Ids are then read off backwards. The work is linear in the text.

Nothing merges across a blank that follows another character or across a line break (checked when
the vocabulary is read), so a text is cut there and each distinct stretch is encoded once per worker.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewright.llm._common import map_texts, vocabulary_path

SPACE = "▁"
MODEL = "piece_bpe_32k.model"
#: Bytes, about, of the stretches that a worker remembers (two generations are held), and how many pairs of pieces.
KEPT_BYTES = 85_000_000
KEPT_PAIRS = 500_000

_tables: dict[str, PieceTable] = {}


class Recent(dict):
    """A dict of texts whose entries move to an old generation, and are then forgotten, as it fills.

    An entry counts as ``fixed`` bytes and ``each`` for a character of its key, so that a few very long texts fill it as many short ones do.
    """

    def __init__(self, most: int, fixed: int, each: int):
        self.most, self.fixed, self.each, self.size, self.old = most, fixed, each, 0, {}

    def __missing__(self, key):
        value = self[key] = self.old[key]
        return value

    def __setitem__(self, key, value):
        if self.size >= self.most:
            self.old = dict(self)
            self.clear()
            self.size = 0
        self.size += self.fixed + self.each * len(key)
        super().__setitem__(key, value)


class PieceTable:
    """The vocabulary of one BPE model file with byte fallback, and the prefix-table encoder."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("this encoder takes BPE models with byte fallback and without text normalisation")
        self.prefix = SPACE if spec.add_dummy_prefix else ""
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (1, 4, 5)}
        self.scores = {p.piece: p.score for p in model.pieces if p.type in (1, 4, 5)}
        if any(p.type in (4, 5) for p in model.pieces):
            raise ValueError("user-defined and unused pieces are not handled")
        self.text_id = {p: str(i) for p, i in self.ids.items()}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == 6}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        joined = [p for p in self.ids if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in joined) or any("\n" in p for p in joined):
            raise ValueError("a piece crosses a blank or a line break")
        self.stretch = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
        self.pair: dict[tuple[str, str], bool] = {}
        self.known: Recent = Recent(KEPT_BYTES, 390, 10)
        self.automaton = ahocorasick.Automaton()
        for p in joined:
            if self.merge(p) == [p]:  # others never come out of merging
                self.automaton.add_word(p, (p, len(p)))
        self.automaton.make_automaton()

    def merge(self, text: str) -> list[str]:
        """Plain merging of a short text: best score first, leftmost of equals. For pair tests."""
        parts, scores = list(text), self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` gives just these two; found once and kept."""
        if len(self.pair) >= KEPT_PAIRS:
            self.pair.clear()
        self.pair[left, right] = found = self.merge(left + right) == [left, right]
        return found

    def split(self, text: str) -> list[str]:
        """The pieces of one stretch, by the prefix table.

        Matches come in order of their ends. Where none can end, the single character does.
        """
        last = [""] * (len(text) + 1)
        seen, test = self.pair.get, self.compatible
        for end, (piece, size) in self.automaton.iter(text):
            end += 1
            if last[end]:
                continue
            start = end - size
            if start:
                before = last[start] or text[start - 1]
                fits = seen((before, piece))
                if fits is None:
                    fits = test(before, piece)
                if not fits:
                    continue
            last[end] = piece
        out, at = [], len(text)
        while at:
            piece = last[at] or text[at - 1]
            out.append(piece)
            at -= len(piece)
        out.reverse()
        return out

    def ids_of(self, piece: str) -> list[int]:
        found = self.ids.get(piece)
        return [found] if found is not None else [self.bytes[b] for b in piece.encode("utf-8")]

    def stretches(self, text: str) -> list[str]:
        return self.stretch.findall(self.prefix + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text, without begin and end marks; none for an empty text."""
        return [i for s in self.stretches(text) for p in self.split(s) for i in self.ids_of(p)]

    def _surface(self, ids: list[int]) -> str:
        """Text of consecutive ids; bytes that are not UTF-8 become U+FFFD, one each."""
        out, run = [], bytearray()

        def flush():
            at = 0
            while at < len(run):
                for size in range(1, 5):
                    try:
                        out.append(bytes(run[at : at + size]).decode("utf-8"))
                        at += size
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run.clear()

        for i in ids:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            flush()
            if self.kinds[i] == 1:
                out.append(self.pieces[i].replace(SPACE, " "))
            elif self.kinds[i] == 2:
                out.append(" ⁇ ")
        flush()
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the blank that encoding puts in front is taken away again."""
        text = self._surface(ids)
        first = next((i for i in ids if self.kinds[i] != 3), None)
        return text[1:] if self.prefix and first is not None and self.pieces[first].startswith(SPACE) else text

    def stretch_entry(self, stretch: str) -> tuple[str, int, str]:
        parts = self.split(stretch)
        try:
            ids = [self.text_id[p] for p in parts]
            entry = (",".join(ids), len(ids), "".join(parts).replace(SPACE, " "))  # plain pieces decode to their own text
        except KeyError:
            ids = [i for p in parts for i in self.ids_of(p)]
            entry = (",".join(map(str, ids)), len(ids), self._surface(ids))
        self.known[stretch] = entry
        return entry

    def encode_and_decode(self, text: str) -> tuple[str, int, str]:
        """``encode`` as comma-joined decimals, their number, and ``decode`` of them.

        Byte pieces never stand on both sides of a cut but for line breaks, which are single
        bytes, so stretches decode on their own.
        """
        known, entry = self.known, self.stretch_entry
        found = []
        for s in self.stretches(text):
            try:
                found.append(known[s])
            except KeyError:
                found.append(entry(s))
        if not found:
            return "", 0, ""
        ids, sizes, texts = zip(*found, strict=True)
        out = "".join(texts)
        return ",".join(ids), sum(sizes), out[1:] if self.prefix and out.startswith(" ") else out


def piece_table(path: str | None = None) -> PieceTable:
    path = path or vocabulary_path(MODEL)
    if path not in _tables:
        _tables[path] = PieceTable(path)
    return _tables[path]


FIELDS = T.StructType([
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.StringType()),
    T.StructField("decoded", T.StringType()),
])


def encode_texts(docs: DataFrame, text: str = "text", model_path: str | None = None) -> DataFrame:
    """Adds ``n_tokens``, ``ids`` (comma-joined decimals) and ``decoded``; drops ``text``.

    Null and empty texts have no ids and decode to an empty text. Very long texts are encoded whole, in time linear in
    them. Other columns pass through, except old ones of the three names; repeated rows stay repeated; an empty table gives an empty
    result. ``model_path`` must exist on every executor; the default is the public file installed with the tokenizers.
    """

    def start():
        table = piece_table(model_path)

        def work(texts):
            found = [table.encode_and_decode(x or "") for x in texts]
            return {name: [x[k] for x in found] for k, name in enumerate(("ids", "n_tokens", "decoded"))}

        return work

    return map_texts(docs.drop("n_tokens", "ids", "decoded"), start, FIELDS, text)


def encoding_digests(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_tokens`` and SHA-256 of the ids and of the decoded text.

    Same handling of nulls and repeats as ``encode_texts``; ids and texts stay inside the task.
    """

    def start():
        table = piece_table(model_path)

        def work(texts):
            out: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for x in texts:
                ids, n, back = table.encode_and_decode(x or "")
                out["n_tokens"].append(n)
                out["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(back.encode("utf-8")).hexdigest())
            return out

        return work

    added = T.StructType([FIELDS["n_tokens"], T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])
    return map_texts(docs.select("doc_id", "text"), start, added)
