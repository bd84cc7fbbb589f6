"""Language identification by compression.

Each language has a raw-content zstandard dictionary made of labelled text in lower case. A text is cut
in blocks, every block is compressed with each dictionary, and the language whose dictionary gives the
fewest bytes in all wins. Where the margin over the runner-up is below ``LOOK_AGAIN`` bytes (mostly very
short texts, as sizes are whole bytes), the text is compressed once more behind several stretches of each
dictionary and the mean growth decides. The score is the winner's share in a softmax over saved bytes.

A text is rejected where the margin is small for its size, below ``CLEAR_MARGIN`` of its compressed bytes, and
the winner's dictionary hardly helps: it saves less than ``MIN_SAVED`` of the bytes that the text takes without
any dictionary, or under ``MIN_SAVED_BYTES``. Texts under ``SHORT_BYTES`` bytes are too short for that, as most save
nothing in their own language; they are rejected by a margin below ``MIN_MARGIN`` bytes, as any text is.

Dictionaries come from a bounded sample of the labelled rows: about ``SAMPLE_DOCS`` texts a language, those with the smallest hashes,
are cut in pieces of ``PIECE_CHARS`` characters, and pieces from anywhere in them fill the dictionary in the order of a hash.
Every language of the labels is learned; all dictionaries together take ``ALL_BYTES`` at most.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm._common import free_name, map_texts

SAMPLE_DOCS = 400
PIECE_CHARS = 2_000
#: Of one dictionary, and of all together: with very many languages each has less.
DICTIONARY_BYTES = 110_000
ALL_BYTES = 64_000_000
BLOCK_BYTES = 16_000
LEVEL = 9
LOOK_AGAIN = 3.0
STRETCHES, STRETCH_BYTES, STRETCH_LEVEL = 8, 2_000, 19
MIN_MARGIN = 0.1
#: Set on labelled rows against languages left out of the dictionaries and random letters.
SHORT_BYTES = 50
CLEAR_MARGIN = 0.1
MIN_SAVED, MIN_SAVED_BYTES = 0.005, 2
UNKNOWN = "und"

Sample = dict[str, bytes]


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", most_bytes: int = DICTIONARY_BYTES) -> Sample:
    """Dictionary contents for each language, ``most_bytes`` at most.

    Rows with a null text or language teach nothing. Equal texts count once. Two passes: distinct texts of each language are
    estimated, then each gives those with the smallest hashes, found by a threshold on the hash so that no sort sees more than a
    small multiple of the sample. Spark cuts the pieces to ``most_bytes`` a language before the driver gets them.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    rows = rows.select("lang", "text", F.pmod(F.xxhash64("text"), F.lit(1 << 30)).alias("h"))
    counts = {r["lang"]: max(1, r["n"]) for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}  # one row a language
    if not counts:
        return {}
    most_bytes = min(most_bytes, ALL_BYTES // len(counts))
    wanted = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1 << 30, (1 << 30) * 4 * SAMPLE_DOCS // n)))))
    near = rows.where(F.col("h") < wanted[F.col("lang")]).dropDuplicates(["lang", "h"])
    firsts = near.withColumn("k", F.expr("row_number() over (partition by lang order by h)")).where(F.col("k") <= SAMPLE_DOCS)
    starts = F.expr(f"explode(sequence(1, greatest(1, length(text)), {PIECE_CHARS}))")
    pieces = firsts.select("lang", "text", starts.alias("at")).select("lang", F.lower(F.expr(f"substring(text, at, {PIECE_CHARS})")).alias("piece"))
    pieces = pieces.distinct().withColumn("before", F.expr("sum(octet_length(piece) + 1) over (partition by lang order by xxhash64(piece), piece) - octet_length(piece)"))
    by_lang: dict[str, list[bytes]] = {}
    for r in pieces.where(F.col("before") <= most_bytes).orderBy("lang", "before").toLocalIterator():  # most_bytes and a piece a language
        by_lang.setdefault(r["lang"], []).append(r["piece"].encode("utf-8"))
    return {k: b"\n".join(texts)[:most_bytes].ljust(8) for k, texts in by_lang.items()}


class Model:
    """The compressors of one language."""

    def __init__(self, lang: str, content: bytes):
        import zstandard as z

        plain = {"write_checksum": False, "write_content_size": False}
        known = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=LEVEL)
        self.lang, self.known = lang, z.ZstdCompressor(level=LEVEL, dict_data=known, **plain)
        self.hard = z.ZstdCompressor(level=STRETCH_LEVEL, **plain)
        step = max(1, len(content) // STRETCHES)
        self.stretches = [(s, len(self.hard.compress(s))) for s in (content[i : i + STRETCH_BYTES] for i in range(0, len(content), step)[:STRETCHES])]

    def size(self, blocks: list[bytes]) -> float:
        return sum(len(self.known.compress(b)) for b in blocks)

    def growth(self, blocks: list[bytes]) -> float:
        return sum(len(self.hard.compress(s + b"\n" + b)) - n for s, n in self.stretches for b in blocks) / len(self.stretches)


def plain_compressor():
    """The size of a block without a dictionary, at the level of the dictionaries."""
    import zstandard as z

    compress = z.ZstdCompressor(level=LEVEL, write_checksum=False, write_content_size=False).compress
    return lambda block: len(compress(block))


def decide(text: str | None, models: list[Model], letter, plain) -> tuple[str, float, float, bool]:
    """Language, score from 0 to 1, margin in bytes, and whether the text is like that language. ``und`` without a letter or without a model."""
    if not text or not models or not letter(text):
        return UNKNOWN, 0.0, 0.0, False
    data = text.lower().encode("utf-8")
    blocks = [data[i : i + BLOCK_BYTES] for i in range(0, len(data), BLOCK_BYTES)]
    found = sorted((m.size(blocks), m.lang) for m in models)
    least = found[0][0]

    def like(margin: float) -> bool:
        if len(data) < SHORT_BYTES or margin >= CLEAR_MARGIN * least:
            return True
        without = sum(map(plain, blocks))
        return without - least >= max(MIN_SAVED_BYTES, MIN_SAVED * without)

    if len(found) == 1:
        return found[0][1], 1.0, float(len(data)), like(0.0)
    if found[1][0] - least < LOOK_AGAIN:
        found = sorted((m.growth(blocks), m.lang) for m in models)
    best = found[0][0]
    margin = found[1][0] - best
    return found[0][1], 1.0 / sum(math.exp(max(-60.0, best - x)) for x, _ in found), margin, like(margin)


def _decider(sample: Sample, min_margin: float):
    """Made once a task: from texts to lists of language, score, margin and whether each is rejected."""
    import regex

    models, letter, plain = [Model(k, v) for k, v in sorted(sample.items())], regex.compile(r"\p{L}").search, plain_compressor()

    def work(texts: list) -> tuple[list, list, list, list]:
        out = [decide(x, models, letter, plain) for x in texts]
        return [o[0] for o in out], [o[1] for o in out], [o[2] for o in out], [o[0] == UNKNOWN or o[2] < min_margin or not o[3] for o in out]

    return work


def identify(docs: DataFrame, sample: Sample, text: str = "text", min_margin: float = MIN_MARGIN, keep_text: bool = False) -> DataFrame:
    """Adds ``lang_pred``, ``score``, ``margin`` and ``rejected``; drops ``text`` unless kept.

    ``rejected`` is true for a margin below ``min_margin`` bytes, for a text that is not like the language found (see
    above), and for ``und``: a null text or one without a letter. Very long texts are compressed block by block, whole. Equal
    sizes go to the language first in order. Only the text counts. Other columns pass through
    except old ones of these names; repeated rows stay; an empty table gives an empty result.
    """
    added = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def start():
        work = _decider(sample, min_margin)
        return lambda texts: dict(zip(added.names, work(texts), strict=True))

    return map_texts(docs.drop(*added.names), start, added, text, keep_text)


def keep_identified(docs: DataFrame, sample: Sample, text: str = "text", lang: str = "lang", min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` without rejected rows, with a missing ``lang`` filled in. Columns, whatever their names, and their order stay."""
    name = free_name(docs, "__found")

    def start():
        work = _decider(sample, min_margin)

        def found(texts):
            langs, _, _, rejected = work(texts)
            return {name: [None if r else x for x, r in zip(langs, rejected, strict=True)]}

        return found

    kept = map_texts(docs, start, T.StructType([T.StructField(name, T.StringType())]), text, keep_text=True).where(F.col(name).isNotNull())
    return kept.select(*(F.coalesce(F.col(f"`{c}`"), F.col(name)).alias(c) if c == lang else F.col(f"`{c}`") for c in docs.columns))
