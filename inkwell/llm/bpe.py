"""Byte-level BPE, encoded and decoded by DuckDB inside the tasks.

Texts are cut into words by the tokenizer's pattern. The distinct words of a chunk become rows (word, position, token);
a recursive query joins neighbouring rows with the merge table and contracts each word's leftmost pair of the lowest
rank until no pair is left. Decoding joins token rows with the vocabulary and puts their bytes together by an
ordered aggregation.
"""

from __future__ import annotations

import base64
import itertools
import re
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from inkwell.llm.common import give_back_memory, read

CHUNK_CHARS = 6_000_000  # texts that are encoded together, in characters
BLOCK_BYTES = 600_000  # bytes of distinct words that one recursive query takes
LONG_WORD = 64  # bytes from which words are contracted at several places in a step
WINDOWED = 1024  # bytes from which a word is contracted in windows that are joined afterwards
WINDOW = 32  # bytes of a window
FAR = 512  # tokens beside a joint from which on the rest of the word is cut into windows anew
STATE_ROWS = 6_000_000  # rows that one recursive query may gather; beyond, it ends early and is started again
DECODE_ROWS = 400_000  # tokens that one decoding query takes
KEPT = 300_000  # pieces from which on the younger generation of the cache becomes the older one

# A blank before a visible character begins a word whatever stands around it, so texts may be cut there first.
CUT = re.compile(r" (?=\S)")

# A step contracts the leftmost pair of the lowest rank in each word. Rank and position are one number, so one minimum
# per word finds the pair.
MERGE_SQL = """
WITH RECURSIVE state(step, w, pos, tok) AS (
  SELECT 0, w, pos, tok FROM symbols
  UNION ALL (
    WITH p AS (
      SELECT step, w, pos, tok, lead(tok) OVER o AS nxt, lag(pos) OVER o AS ppos
      FROM state WHERE step < {steps} WINDOW o AS (PARTITION BY w ORDER BY pos)
    ), pairs AS MATERIALIZED (
      SELECT p.*, CAST(m.r AS BIGINT) * 1048576 + pos AS pair
      FROM p LEFT JOIN merges m ON m.a = p.tok AND m.b = p.nxt
    ), lows AS MATERIALIZED (
      SELECT w, min(pair) AS low FROM pairs GROUP BY w HAVING min(pair) IS NOT NULL
    )
    SELECT step + 1, pairs.w, pos, CASE WHEN pos = low % 1048576 THEN CAST(low // 1048576 AS INT) ELSE tok END
    FROM pairs JOIN lows ON lows.w = pairs.w
    WHERE ppos IS DISTINCT FROM low % 1048576
  )
), ends AS (
  SELECT w, max(step) AS step FROM state GROUP BY w
)
SELECT step, w, pos, tok FROM state JOIN ends USING (w, step) ORDER BY w, pos
"""

# The same result for long words in fewer steps: a step contracts all pairs of a word's lowest rank, from left to right
# without overlap. That equals contracting the leftmost again and again unless a contraction makes a pair of a lower
# rank than its own; "early" has the pairs that can, and a word stops after the first contraction that stands beside one.
LONG_SQL = """
WITH RECURSIVE state(step, w, pos, tok) AS (
  SELECT 0, w, pos, tok FROM symbols
  UNION ALL (
    WITH p AS (
      SELECT step, w, pos, tok, lead(pos) OVER o AS npos, lead(tok) OVER o AS nxt, lead(tok, 2) OVER o AS nxt2,
        lag(tok) OVER o AS prv
      FROM state WHERE step < {steps} WINDOW o AS (PARTITION BY w ORDER BY pos)
    ), pairs AS MATERIALIZED (
      SELECT p.*, m.r FROM p LEFT JOIN merges m ON m.a = p.tok AND m.b = p.nxt
    ), lows AS MATERIALIZED (
      SELECT w, min(r) AS low FROM pairs GROUP BY w HAVING min(r) IS NOT NULL
    ), lowest AS (
      SELECT pairs.*, coalesce(lag(npos) OVER (PARTITION BY pairs.w ORDER BY pos) = pos, false) AS joined
      FROM pairs JOIN lows ON lows.w = pairs.w AND pairs.r = lows.low
    ), runs AS (
      SELECT *, sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (PARTITION BY w ORDER BY pos) AS run FROM lowest
    ), numbered AS (
      SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY pos) AS n FROM runs
    ), chosen AS (
      SELECT c.w, c.pos, c.npos, c.r, (x.a IS NOT NULL OR y.a IS NOT NULL OR z.a IS NOT NULL) AS stops
      FROM numbered c
      LEFT JOIN early x ON x.a = c.prv AND x.b = c.r
      LEFT JOIN early y ON y.a = c.r AND y.b = c.nxt2
      LEFT JOIN early z ON z.a = c.r AND z.b = c.r
      WHERE n % 2 = 1
    ), stops AS (
      SELECT w, min(pos) AS last FROM chosen WHERE stops GROUP BY w
    ), done AS MATERIALIZED (
      SELECT c.w, pos, npos, r FROM chosen c LEFT JOIN stops ON stops.w = c.w WHERE last IS NULL OR pos <= last
    )
    SELECT pairs.step + 1, pairs.w, pairs.pos, coalesce(d.r, pairs.tok)
    FROM pairs JOIN lows ON lows.w = pairs.w LEFT JOIN done d ON d.w = pairs.w AND d.pos = pairs.pos
    WHERE NOT EXISTS (SELECT 1 FROM done gone WHERE gone.w = pairs.w AND gone.npos = pairs.pos)
  )
), ends AS (
  SELECT w, max(step) AS step FROM state GROUP BY w
)
SELECT step, w, pos, tok FROM state JOIN ends USING (w, step) ORDER BY w, pos
"""

# Bytes travel as the characters of the same numbers, so that they can be put together as text.
DECODE_SQL = """
SELECT doc, string_agg(piece, '' ORDER BY pos) AS bytes
FROM tokens JOIN vocabulary ON vocabulary.id = tokens.id GROUP BY doc ORDER BY doc
"""


class Codec:
    """One tokenizer in one worker process: its DuckDB tables and the pieces of text met lately."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        rank = {base64.b64decode(word): int(number) for word, number in (line.split() for line in ranks.splitlines() if line)}
        pairs = [
            (rank[word[:i]], rank[word[i:]], number)
            for word, number in rank.items() for i in range(1, len(word)) if word[:i] in rank and word[i:] in rank
        ]
        a, b, r = (pa.array(column, pa.int32()) for column in zip(*pairs)) if pairs else (pa.array([], pa.int32()),) * 3
        self.tables = {
            "merges": pa.table({"a": a, "b": b, "r": r}),
            "vocabulary": pa.table({
                "id": pa.array(list(rank.values()), pa.int32()),
                "piece": pa.array([word.decode("latin-1") for word in rank], pa.string())}),
        }
        self.pattern = regex.compile(pattern)
        self.of_byte = np.array([rank[bytes([i])] for i in range(256)], np.int32)
        self.bytes_of = {number: word for word, number in rank.items()}
        self.whole = {word: np.int32(number).tobytes() for word, number in rank.items()}
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.con: duckdb.DuckDBPyConnection | None = None

    def open(self) -> None:
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB", "temp_directory": ""})
        for name, rows in self.tables.items():
            self._table(name, rows)
        self.con.execute("CREATE TABLE early AS SELECT a, b FROM merges WHERE r < greatest(a, b)")

    def release(self) -> None:
        """Gives back what an idle worker need not hold; the younger pieces stay for the next task."""
        if self.con is not None:
            self.con.close()
            self.con = None
        self.old = {}
        give_back_memory()

    def _table(self, name: str, rows: pa.Table) -> None:
        self.con.register("given", rows)
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _query(self, sql: str, name: str, rows: pa.Table) -> pa.Table:
        if self.con is None:
            self.open()
        self.con.register(name, rows)
        try:
            return self.con.sql(sql).to_arrow_table()
        finally:
            self.con.unregister(name)

    def _contract(self, words: list[bytes], sql: str) -> list[bytes]:
        """Token ids of each word (as the bytes of 32-bit numbers), by recursive queries until nothing changes."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = (np.arange(len(word)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        tok = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        settled: list[tuple[np.ndarray, np.ndarray]] = []
        while len(word):
            steps = max(4, STATE_ROWS // len(word))
            found = self._query(sql.format(steps=steps), "symbols", pa.table({"w": word, "pos": pos, "tok": tok}))
            step, word, pos, tok = (found.column(i).to_numpy() for i in range(4))
            open_ = step == steps
            settled.append((word[~open_], tok[~open_]))
            word, pos, tok = word[open_], pos[open_], tok[open_]
        word, tok = (np.concatenate(parts) for parts in zip(*settled))
        ids = tok[np.argsort(word, kind="stable")].astype(np.int32).tobytes()
        ends = (4 * np.cumsum(np.bincount(word, minlength=len(words)))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _contract_all(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Token ids of each distinct word by contraction alone, in blocks; words of like length settle after like
        numbers of steps."""
        known: dict[bytes, bytes] = {}
        distinct = sorted(set(words), key=len)
        at = next((i for i, w in enumerate(distinct) if len(w) >= LONG_WORD), len(distinct))
        for group, sql in ((distinct[:at], MERGE_SQL), (distinct[at:], LONG_SQL)):
            start = size = 0
            for i, word in enumerate(group):
                size += len(word)
                if size >= BLOCK_BYTES or i == len(group) - 1:
                    known.update(zip(group[start:i + 1], self._contract(group[start:i + 1], sql)))
                    start, size = i + 1, 0
        return known

    def _windowed(self, word: bytes) -> bytes:
        """Token ids of a very long word: its windows are contracted alone, then made good where they meet.

        Tokens are the contraction of their bytes exactly if each two neighbours are that of theirs. So the pairs at the
        joints are contracted; around those that come out otherwise, a stretch of tokens on both sides is contracted
        anew, which leaves joints at its ends, and stretches double until all joints hold. Where that goes far, as in
        runs of one letter whose windows begin at the wrong one, the rest is cut anew from a token's end, in windows of
        whole tokens.
        """
        tokens, joints = self._in_windows(word, WINDOW)
        reach = 4
        while len(joints):
            bad = joints[~self._holds(tokens, joints)]
            if not len(bad):
                break
            low, high = np.maximum(bad - reach, 0), np.minimum(bad + reach, len(tokens))
            first = np.r_[True, low[1:] > high[:-1]]
            ends = high[np.r_[first[1:], True]]
            if reach > FAR or (ends - low[first]).max() > 8 * FAR:
                far = slice(max(0, int(bad[0]) - FAR), int(bad[0]) + FAR)
                new = np.frombuffer(self._contract_all([stretch := self._joined(tokens[far])])[stretch], np.int32)
                kept, last = new[:-64], new[-64:]
                sizes = np.cumsum([len(self.bytes_of[t]) for t in last.tolist()])
                window = int(sizes[np.searchsorted(sizes, min(WINDOW, sizes[-1]))])
                rest, more = self._in_windows(self._joined(last) + self._joined(tokens[far.stop:]), window)
                tokens = np.concatenate([tokens[:far.start], kept, rest])
                start = far.start + len(kept)
                joints, reach = np.r_[far.start, start, more + start], 4
            else:
                low, high = low[first].tolist(), ends.tolist()
                stretches = [self._joined(tokens[a:b]) for a, b in zip(low, high)]
                ids_of = self._contract_all(stretches)
                made, at, joints, size = [], 0, [], 0
                for a, b, stretch in zip(low, high, stretches):
                    new = np.frombuffer(ids_of[stretch], np.int32)
                    made += [tokens[at:a], new]
                    joints += [size + a - at, size + a - at + len(new)]
                    size, at = joints[-1], b
                tokens = np.concatenate([*made, tokens[at:]])
                reach *= 2
            joints = np.unique(joints).astype(np.int64)
            joints = joints[(joints > 0) & (joints < len(tokens))]
        return tokens.astype(np.int32).tobytes()

    def _joined(self, tokens: np.ndarray) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, tokens.tolist()))

    def _in_windows(self, word: bytes, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of a word whose windows are contracted alone, and the places where windows meet."""
        pieces = [word[i:i + window] for i in range(0, len(word), window)]
        ids_of = self._contract_all(pieces)
        parts = [np.frombuffer(ids_of[p], np.int32) for p in pieces]
        return np.concatenate(parts), np.cumsum(list(map(len, parts)))[:-1]

    def _holds(self, tokens: np.ndarray, joints: np.ndarray) -> np.ndarray:
        """For each joint whether the two tokens beside it are what their bytes are contracted to."""
        pairs, which = np.unique(np.stack([tokens[joints - 1], tokens[joints]], 1), axis=0, return_inverse=True)
        joined = [self.bytes_of[a] + self.bytes_of[b] for a, b in pairs.tolist()]
        ids_of = self._contract_all(joined)
        return np.array([ids_of[w] == pair.tobytes() for w, pair in zip(joined, pairs)])[which.reshape(-1)]

    def _words(self, words: set[str]) -> dict[str, bytes]:
        """Token ids of each distinct word: known as a piece, from the vocabulary, or by contraction."""
        known: dict[str, bytes] = {}
        others: dict[str, bytes] = {}
        for w in words:
            ids = self.young.get(w) or self.old.get(w)
            if ids is None:
                data = w.encode("utf-8")
                ids = self.whole.get(data)
                if ids is None and len(data) >= WINDOWED:
                    ids = self._windowed(data)
                if ids is None:
                    others[w] = data
                    continue
            known[w] = ids
        ids_of = self._contract_all(list(others.values()))
        known.update((w, ids_of[data]) for w, data in others.items())
        return known

    def _pieces(self, strings: list[str]) -> list[bytes]:
        """Token ids of each distinct piece of text, from the cache or by those of its words."""
        known = list(map(self.young.get, strings))
        missing = []
        for i, ids in enumerate(known):
            if ids is None:
                known[i] = self.old.get(strings[i])
                if known[i] is None:
                    missing.append(i)
        # letters after a blank are one word
        words = [[p] if p[:1] == " " and p[1:].isalpha() else self.pattern.findall(p) for p in map(strings.__getitem__, missing)]
        ids_of = self._words({w for parts in words for w in parts})
        for i, parts in zip(missing, words):
            known[i] = b"".join([ids_of[w] for w in parts])
        if len(self.young) > KEPT:
            self.old, self.young = self.young, {}
        room = max(0, 2 * KEPT - len(self.young))
        self.young.update(itertools.islice(((p, ids) for p, ids in zip(strings, known) if len(p) < LONG_WORD), room))
        return known

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All token ids one after another, and the number of ids of each text."""
        codes, strings = cut_texts(texts)
        of_piece = self._pieces(strings)
        lengths = np.fromiter(map(len, of_piece), np.int64, len(of_piece)) // 4
        starts = np.cumsum(lengths) - lengths
        flat = np.frombuffer(b"".join(of_piece), np.int32)
        at = np.concatenate([np.empty(0, np.int64), *codes])
        size = lengths[at]
        ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *map(len, codes)])]
        index = np.arange(size.sum()) + np.repeat(starts[at] - (np.cumsum(size) - size), size)
        return flat[index], np.diff(ends)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each text whose token ids stand one after another in ``ids``; unknown ids have none."""
        out: list[list[bytes]] = [[] for _ in counts]
        doc = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        for start in range(0, len(ids), DECODE_ROWS):
            part = slice(start, start + DECODE_ROWS)
            rows = pa.table({"doc": doc[part], "pos": np.arange(len(ids[part]), dtype=np.int32), "id": ids[part]})
            found = self._query(DECODE_SQL, "tokens", rows)
            for d, piece in zip(found.column(0).to_pylist(), found.column(1).to_pylist()):
                out[d].append(piece.encode("latin-1"))
        return [b"".join(pieces) for pieces in out]


def cut_texts(texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
    """Cuts texts before each blank that a visible character follows: the pieces' numbers for each text, and the pieces.

    Cut at every blank first, and texts in which that parts blanks from blanks are cut once more, by the exact rule.
    """
    lists = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    offsets = lists.offsets.to_numpy()
    encoded = lists.flatten().dictionary_encode()
    numbers = encoded.indices.to_numpy().astype(np.int64)
    after_blank = encoded.dictionary.to_pylist()
    strings = [" " + p for p in after_blank]
    wrong = np.fromiter((not p or p[0].isspace() for p in after_blank), bool, len(after_blank))[numbers]
    # the first piece of a text has no blank before it, so it is numbered apart
    heads: dict[str, int] = {}
    first = offsets[:-1]
    wrong[first] = False
    numbers[first] = [len(strings) + heads.setdefault(after_blank[i], len(heads)) for i in numbers[first].tolist()]
    strings += heads
    codes = np.split(numbers, offsets[1:-1])
    again: dict[str, int] = {}
    for i in np.unique(np.searchsorted(offsets, np.flatnonzero(wrong), side="right") - 1).tolist():
        head, *rest = CUT.split(texts[i])
        codes[i] = np.array([len(strings) + again.setdefault(p, len(again)) for p in (head, *(" " + r for r in rest))], np.int64)
    return codes, strings + [*again]


_CODECS: dict[tuple[int, str], Codec] = {}


def codec(ranks: bytes, pattern: str) -> Codec:
    key = (hash(ranks), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(ranks, pattern)
    return _CODECS[key]


def chunks(batch: pa.RecordBatch, column: int, rows: int = 2048) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of a batch of up to ``rows`` rows and about CHUNK_CHARS characters of text, at least one row each; null
    texts are empty."""
    for first in range(0, batch.num_rows, rows):
        part = batch.slice(first, rows)
        texts = [t or "" for t in part.column(column).to_pylist()]
        start = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= CHUNK_CHARS or i == len(texts) - 1:
                yield part.slice(start, i + 1 - start), texts[start:i + 1]
                start, size = i + 1, 0


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))


def _ranks(path: str) -> bytes:
    """The rank file, read on the driver and sent with the tasks (under a megabyte)."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """(id, ids) per row, ids the token ids of the whole text; with ``decoded`` also the bytes that they decode to.

    Null and empty texts have no ids. Ids of rows may be null or repeat, other columns are ignored, an empty table
    gives an empty result. Rows never leave their partition; a task holds one chunk of texts, or one longer text; words of
    megabytes are contracted in windows, so their size bounds neither memory of a query nor its steps.
    """
    ranks = _ranks(ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            for part, texts in chunks(batch, 1):
                ids, counts = own.encode(texts)
                columns, names = [part.column(0), _lists(ids, counts)], [id_col, "ids"]
                if decoded:
                    columns, names = [*columns, pa.array(own.decode(ids, counts), pa.binary())], [*names, "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        own.release()

    rows = docs.select(id_col, F.col(text_col).cast("string").alias("text"))
    schema = f"`{id_col}` {dict(rows.dtypes)[id_col]}, ids array<int>" + ", decoded binary" * decoded
    return rows.mapInArrow(run, schema)


def decode(tokens: DataFrame, ranks_path: str, pattern: str, *, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded) per row: the bytes of its token ids. Null or empty ids give no bytes, null and unknown ids in them none."""
    ranks = _ranks(ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                lists = [np.array([i for i in x or [] if i is not None], np.int32) for x in part.column(1).to_pylist()]
                counts = np.fromiter(map(len, lists), np.int64, len(lists))
                made = own.decode(np.concatenate([np.empty(0, np.int32), *lists]), counts)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary())], names=[id_col, "decoded"])
        own.release()

    rows = tokens.select(id_col, F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, f"`{id_col}` {dict(rows.dtypes)[id_col]}, decoded binary")


def digests(tokens: DataFrame, *more: str, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, more columns) of rows with ids and decoded."""
    return tokens.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *more,
    )


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again, with digests of both."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return digests(encode(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, decoded=True))
