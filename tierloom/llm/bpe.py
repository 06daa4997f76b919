"""Byte-level BPE as recursive queries of DuckDB, run per partition.

The merge table holds every pair of tokens whose bytes together are a token,
with that token's rank. A text's pattern matches become rows (word, position,
token), first one per byte; the recursive query joins neighbouring rows with
the merge table and contracts in each word the leftmost pair of the least
rank, until a round finds none. Distinct words are encoded once and
remembered. An
ordered aggregation over (document, position, token) rows decodes.

Very long words are cut into stretches twice as long as any token. A pair is
then contracted if no stretch next to its own holds a pair that comes first:
what happens farther away can't reach it, as it would have to grow into a token
longer than any. Pairs of one rank are contracted together, from the left, over
neighbouring stretches too, up to the first one whose contraction would bring
up another pair that comes before the next. Most tokens are calm, as no merge
that has them as a part ranks before them; for others the tokens around are
looked at. So a run of one character, or of a few, takes rounds in proportion
to the logarithm of its length, with the same result.

Defined cases: a null text is an empty one and has no ids; ids decode to the
very bytes of the text; repeated rows are encoded each; extra columns are not
read, or returned as they are by ``encode``; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from tierloom.llm.common import fresh, load_ranks, per_worker, vocabulary_path
from tierloom.llm.pieces import REMEMBERED, PieceEncoder, Spans

#: Bytes of words that one recursive query takes.
QUERY_BYTES = 1 << 19
#: Tokens that one decoding query takes.
QUERY_TOKENS = 1 << 20
MEMORY = "256MB"
#: Bytes of a word that has its rows rewritten each round; longer words change only the rows they must.
SHORT = 64

Batches = Iterator[pa.RecordBatch]


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """(a, b, merged, calm): pairs of ids whose bytes together are the token ``merged``; its id is its rank.

    ``calm``: no merge that has ``merged`` as a part ranks before it.
    """
    rows = [
        (ranks[token[:cut]], ranks[token[cut:]], merged)
        for token, merged in ranks.items()
        for cut in range(1, len(token))
        if token[:cut] in ranks and token[cut:] in ranks
    ]
    left, right, merged = zip(*rows, strict=True) if rows else ((), (), ())
    stirred = {part for a, b, whole in rows for part in (a, b) if whole < part}
    return pa.table(
        {
            "a": pa.array(left, pa.int32()),
            "b": pa.array(right, pa.int32()),
            "merged": pa.array(merged, pa.int32()),
            "calm": pa.array([whole not in stirred for whole in merged], pa.bool_()),
        }
    )


# state: the live rows of words that the last round changed; a word whose pairs are in no merge is not seen again, and
# its rows of the last round it was in are its result. taken: each word's leftmost pair of the least rank, and the row
# it takes in. A short word's places fit in seven bits.
ENCODE_SHORT = """
WITH RECURSIVE state(word, place, token, round) AS (
  SELECT word, place, token, 0 FROM tokens
  UNION ALL
  (
    WITH pair AS (
      SELECT s.*, m.merged
      FROM (SELECT *, lead(place) OVER w AS next, lead(token) OVER w AS right_token
            FROM state WINDOW w AS (PARTITION BY word ORDER BY place)) s
      LEFT JOIN merges m ON m.a = s.token AND m.b = s.right_token
    ),
    taken AS (
      SELECT word, min(merged << 7 | place) & 127 AS place, arg_min(next, merged << 7 | place) AS gone
      FROM pair WHERE merged IS NOT NULL GROUP BY word
    )
    SELECT p.word, p.place, CASE WHEN p.place = t.place THEN p.merged ELSE p.token END, p.round + 1
    FROM pair p JOIN taken t ON t.word = p.word WHERE p.place <> t.gone
  )
)
SELECT word, token FROM state
JOIN (SELECT word, max(round) AS round FROM state GROUP BY word) USING (word, round) ORDER BY word, place
"""
# The same for words of any length.
# state: one row per byte position of a word; its token, none once a token before it has taken it in, and the place
# of the next live row. A round sees the rows that the last one changed as state, and all rows as recurring.state.
# pair: live rows of the words that changed, each with the token its pair merges into, if any.
# best: the least token that each stretch's pairs merge into. edged: also those of the stretches beside it.
# level: neighbouring stretches with one such token, numbered; shut, if the stretch before them has a lesser one.
# able: their pairs that merge into it, but for a last stretch whose right neighbour has a lesser one.
# free: pairs that share a row follow each other in one chain; every other one of a chain is free.
# around: the tokens beside a free pair that is not calm; grown: what its token and the one before it merge into at once.
# stirring: such pairs after which a pair would come first that could reach the next free one.
ENCODE_LONG = """
WITH RECURSIVE state(word, place, token, next) USING KEY (word, place) AS (
  SELECT word, place, token, place + 1 FROM tokens
  UNION
  (
    WITH pair AS (
      SELECT l.word, l.place, l.place // $span AS stretch, l.next, r.next AS after, m.merged, m.calm
      FROM recurring.state l
      SEMI JOIN state changed ON changed.word = l.word
      JOIN recurring.state r ON r.word = l.word AND r.place = l.next
      JOIN merges m ON m.a = l.token AND m.b = r.token
    ),
    best AS (SELECT word, stretch, min(merged) AS merged FROM pair GROUP BY word, stretch),
    edged AS (
      SELECT b.*, l.merged AS before, r.merged AS behind FROM best b
      LEFT JOIN best l ON l.word = b.word AND l.stretch = b.stretch - 1
      LEFT JOIN best r ON r.word = b.word AND r.stretch = b.stretch + 1
    ),
    levels AS (
      SELECT *, count(*) FILTER (before IS DISTINCT FROM merged) OVER (PARTITION BY word ORDER BY stretch) AS level
      FROM edged
    ),
    open AS (
      SELECT *, bool_or(coalesce(before < merged, false)) OVER (PARTITION BY word, level) AS shut FROM levels
    ),
    able AS (
      SELECT p.*, o.level FROM pair p JOIN open o ON o.word = p.word AND o.stretch = p.stretch AND o.merged = p.merged
      WHERE NOT o.shut AND coalesce(o.behind >= o.merged, true)
    ),
    linked AS (
      SELECT *, place IS DISTINCT FROM lag(next) OVER w AS begins FROM able
      WINDOW w AS (PARTITION BY word, level ORDER BY place)
    ),
    free AS (
      SELECT * FROM (
        SELECT *, count(*) FILTER (begins) OVER (PARTITION BY word, level ORDER BY place) AS chain FROM linked
      ) QUALIFY row_number() OVER (PARTITION BY word, level, chain ORDER BY place) % 2 = 1
    ),
    back AS (SELECT word, next AS place, place AS prior, token FROM recurring.state WHERE token IS NOT NULL),
    around AS (
      SELECT f.word, f.level, f.place, f.merged, r.token AS behind, ll.token AS far, x.merged AS grown
      FROM (SELECT * FROM free WHERE NOT calm QUALIFY count(*) OVER (PARTITION BY word, level) > 1) f
      LEFT JOIN recurring.state r ON r.word = f.word AND r.place = f.after
      LEFT JOIN back l ON l.word = f.word AND l.place = f.place
      LEFT JOIN back ll ON ll.word = f.word AND ll.place = l.prior
      LEFT JOIN sooner x ON x.a = l.token AND x.b = f.merged
    ),
    met AS (
      SELECT word, place, merged, unnest([(merged, behind), (merged, merged), (merged, grown), (grown, behind),
                                          (grown, grown), (grown, merged), (far, grown)]) AS two FROM around
    ),
    stirring AS (
      SELECT t.word, t.place FROM met t JOIN merges m ON m.a = t.two[1] AND m.b = t.two[2] WHERE m.merged < t.merged
      UNION
      SELECT word, place FROM around
      QUALIFY lead(grown) OVER (PARTITION BY word, level ORDER BY place) <> grown
    ),
    taken AS (
      SELECT f.word, f.place, f.merged, f.next, f.after FROM free f
      LEFT JOIN stirring s ON s.word = f.word AND s.place = f.place
      QUALIFY count(s.place) OVER (
        PARTITION BY f.word, f.level ORDER BY f.place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 0
    )
    SELECT word, place, merged, after FROM taken
    UNION ALL
    SELECT word, next, NULL, NULL FROM taken
  )
)
SELECT word, token FROM state WHERE token IS NOT NULL ORDER BY word, place
"""
DECODE = "SELECT doc, array_to_string(list(bytes ORDER BY place), '') AS text FROM rows JOIN vocabulary USING (token) GROUP BY doc"


class DuckBpe:
    """Encoder and decoder of one task, with its vocabulary's tables in an in-memory DuckDB."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import duckdb
        import regex

        self.ranks, self.remembered = ranks, REMEMBERED
        self.numbers: dict[str, int] = {}
        self.known = Spans()
        self.find = regex.compile(pattern).findall
        self.encode_long = ENCODE_LONG.replace("$span", str(2 * max(map(len, ranks))))
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self.byte_ids = np.array([ranks[bytes([value])] for value in range(256)], np.int32)
        merges = merge_table(ranks)  # noqa: F841
        self.db.execute("CREATE TABLE merges AS FROM merges")
        self.db.execute("CREATE TABLE sooner AS SELECT a, b, merged FROM merges WHERE merged < b")
        vocabulary = pa.table({"token": list(ranks.values()), "bytes": [token.hex() for token in ranks]})  # noqa: F841
        self.db.execute("CREATE TABLE vocabulary AS SELECT token::INT AS token, bytes FROM vocabulary")

    def _merge(self, words: list[bytes], query: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and their number per word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        data = np.frombuffer(b"".join(words), np.uint8)
        place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        tokens = pa.table({"word": word, "place": place.astype(np.int32), "token": self.byte_ids[data]})  # noqa: F841
        done = self.db.sql(query).to_arrow_table()
        return done["token"].to_numpy().astype(np.uint32), np.bincount(done["word"].to_numpy(), minlength=len(words))

    def _learn(self, words: list[bytes], query: str) -> None:
        """Remember the ids of new words; a query takes a bounded number of bytes."""
        begin = size = 0
        for end, word in enumerate(words, 1):
            size += len(word)
            if size >= QUERY_BYTES or end == len(words):
                self.known.add(*self._merge(words[begin:end], query))
                begin, size = end, 0

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and their number per text; each distinct match of the pattern is merged once."""
        found = [self.find(text) for text in texts]
        new = {word: word.encode() for words in found for word in words if word not in self.numbers}
        whole = [word for word, raw in new.items() if raw in self.ranks]  # a word that is a token is that token
        rest = [word for word, raw in new.items() if raw not in self.ranks]
        short = [word for word in rest if len(new[word]) <= SHORT]
        long_ = [word for word in rest if len(new[word]) > SHORT]
        self.numbers.update(zip([*whole, *short, *long_], range(len(self.known), len(self.known) + len(new)), strict=True))
        self.known.add(np.array([self.ranks[new[word]] for word in whole], np.uint32), np.ones(len(whole), np.int64))
        self._learn([new[word] for word in short], ENCODE_SHORT)
        self._learn([new[word] for word in long_], self.encode_long)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        used = np.fromiter((self.numbers[word] for words in found for word in words), np.int64, int(counts.sum()))
        ends = np.concatenate([[0], np.cumsum(self.known.sizes[used])])
        ids = self.known.of(used)
        if len(self.known) > self.remembered:
            while next(reversed(self.numbers.values())) >= self.remembered:
                self.numbers.popitem()
            self.known.keep(self.remembered)
        return ids, np.diff(ends[np.cumsum(counts)], prepend=0)

    def decode_many(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The bytes of each text, in hex: an ordered aggregation of its tokens' bytes, QUERY_TOKENS at a time."""
        doc, texts = np.repeat(np.arange(len(sizes)), sizes), [""] * len(sizes)
        for at in range(0, len(ids), QUERY_TOKENS):
            part = slice(at, at + QUERY_TOKENS)
            tokens = ids[part].astype(np.int32)
            rows = pa.table({"doc": doc[part], "place": np.arange(len(tokens)), "token": tokens})  # noqa: F841
            found = self.db.sql(DECODE).to_arrow_table()
            for number, text in zip(found["doc"].to_pylist(), found["text"].to_pylist(), strict=True):
                texts[number] += text
        return texts


RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Documents that are encoded and decoded together.
TOGETHER = 256


def _default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _encoder(path: str, pattern: str, remembered: int) -> tuple[DuckBpe, PieceEncoder]:
    """The encoder of this Python worker; it remembers so many words and pieces, about 700 bytes for each of both."""

    def make() -> tuple[DuckBpe, PieceEncoder]:
        bpe = DuckBpe(load_ranks(path), pattern)
        bpe.remembered = remembered
        return bpe, PieceEncoder(bpe.encode_many, remembered)

    return per_worker(("bpe", path, pattern, remembered), make)


def encode(
    docs: DataFrame,
    decode: bool = False,
    vocabulary: str = "byte_bpe_multi_50k.tiktoken",
    pattern: str | None = None,
    remembered: int = REMEMBERED,
) -> DataFrame:
    """The documents with a column ``ids`` (array of int), and ``decoded`` (the ids' text) if asked for.

    Both are renamed if they would clash with a column of the documents.
    """
    path, pattern = vocabulary_path(vocabulary), pattern or _default_pattern()
    names = [fresh(docs.columns, name) for name in ("ids", "decoded")[: 1 + decode]]
    text_at = docs.columns.index("text")

    def scan(batches: Batches) -> Batches:
        bpe, pieces = _encoder(path, pattern, remembered)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                ids, sizes = pieces.encode([text or "" for text in part.column(text_at).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                found = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))]
                if decode:
                    found.append(pa.array([bytes.fromhex(x).decode() for x in bpe.decode_many(ids, sizes)], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *found], [*part.schema.names, *names])

    added = [StructField(names[0], ArrayType(IntegerType())), *(StructField(name, StringType()) for name in names[1:])]
    return docs.mapInArrow(scan, StructType([*docs.schema.fields, *added]))


def round_trip(
    docs: DataFrame,
    vocabulary: str = "byte_bpe_multi_50k.tiktoken",
    pattern: str | None = None,
    remembered: int = 2 * REMEMBERED,
) -> DataFrame:
    """Encode every text and decode its ids: doc_id, n_tokens, and digests of the ids and of the decoded bytes."""
    path, pattern = vocabulary_path(vocabulary), pattern or _default_pattern()

    def scan(batches: Batches) -> Batches:
        bpe, pieces = _encoder(path, pattern, remembered)
        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                part = batch.slice(at, TOGETHER)
                ids, sizes = pieces.encode([text or "" for text in part.column("text").to_pylist()])
                ends = np.cumsum(sizes)
                digests = [hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in np.split(ids, ends[:-1])]
                decoded = [hashlib.sha256(bytes.fromhex(x)).hexdigest() for x in bpe.decode_many(ids, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), pa.array(digests), pa.array(decoded)],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scan, RESULT)
