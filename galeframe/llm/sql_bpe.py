"""Byte-level BPE encoding and decoding by recursive queries of DuckDB, one database for each partition's worker.

A worker's database holds the vocabulary and the merge table: every pair of tokens whose bytes are together a token, with
its rank. A batch's texts are split into words; words not met before become rows (word, pos, token). A recursive query
joins neighbours with the merge table, contracts each word's leftmost pair of least rank, and stops where no word has a
pair left. Texts are their words' ids, aggregated in order; decoding aggregates the bytes of ids in order.

A word of more than LONG bytes would need about as many steps as it has bytes, each over all of them. For such words a
step contracts, with the leftmost pair, all equal pairs. That changes nothing unless a contracted token takes part in a
pair of lower rank than its own ("unruly"), as another occurrence might then have to wait; the merge table tells which
do, and those are contracted one at a time. A recursive query keeps the rows of all its steps, so it takes only as many
as STEP_ROWS allows for its words, and another one continues from its last: a word of a million letters costs time, but
bounded memory.

As in the tiktoken library, a word that is itself a token is that token. Edge cases: a null text is encoded as an empty
one: no ids, and a decoded text of no bytes. Special tokens are ordinary text. Texts are encoded whole. Ids outside the
vocabulary are an error when decoding. Rows are told apart by their place, so doc_ids may be null or repeated. Other
columns are ignored. Empty tables give empty ones.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Rows and bytes of text that are encoded together; a longer text comes alone.
TOGETHER, CHARS = 2000, 4 << 20
#: Words that a worker remembers, bytes of a word that is contracted pair by pair, and rows and steps of one recursive query over longer ones.
REMEMBERED, LONG, STEP_ROWS, STEPS = 1_500_000, 64, 8_000_000, 128
#: No rank, and more places than a word has; their product fits 64 bits.
NEVER, WIDE = 1 << 32, 1 << 30

#: White space, as Unicode's White_Space: a fixed value.
SPACE = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: Words as the tokenizer's pattern parts them. Its look-ahead (a run of white space leaves its last sign to what follows)
#: becomes a mark put before that sign; the mark is a private sign that no text of the batch holds, and no word.
MARKED = rf"regexp_replace(text, '([{SPACE}])([{SPACE}][^{SPACE}])', '\1MARK\2', 'g')"
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}MARK]+|[{SPACE}]+|MARK"
MARKS = range(0xF0000, 0xFFFFE)

#: From the words of `fresh` (word, pos, token): each step joins the pairs of every word and contracts the best.
CONTRACT_SHORT = """
    CREATE OR REPLACE TEMP TABLE merged AS
    WITH RECURSIVE state(word, tokens) AS (
        SELECT word, list(token ORDER BY pos) FROM fresh GROUP BY word HAVING count(*) <= {long}
        UNION ALL
        SELECT s.word, list_concat(tokens[:place - 1], [CAST(rank AS INTEGER)], tokens[place + 2:])
        FROM state s JOIN (
            SELECT word, min(rank * {wide} + place) // {wide} AS rank, min(rank * {wide} + place) % {wide} AS place
            FROM (SELECT word, unnest(tokens[:-2]) AS a, unnest(tokens[2:]) AS b, unnest(range(1, len(tokens))) AS place FROM state)
            JOIN merges USING (a, b) GROUP BY word
        ) USING (word)
    )
    SELECT word, arg_min(tokens, len(tokens)) AS ids FROM state GROUP BY word
"""
#: From `fresh` (word, pos, token), now of long words, on: the last rows of all words, which have no pair left unless `steps` ended them.
CONTRACT_LONG = """
    CREATE OR REPLACE TEMP TABLE reached AS
    WITH RECURSIVE state(word, pos, token, step, more) AS (
        SELECT word, pos, token, 0, true FROM fresh
        UNION ALL
        SELECT word, pos, CASE WHEN contract THEN rank ELSE token END, step + 1, least < {never}
        FROM (
            SELECT *, rank < {never} AND (place = leftmost OR rank = least AND NOT unruly AND (token <> following OR (place - first) % 2 = 0)) AS contract,
                   before < {never} AND (place - 1 = leftmost OR before = least AND NOT unruly_before AND (previous <> token OR (place - 1 - first) % 2 = 0)) AS absorbed
            FROM (
                SELECT *, min(rank * {wide} + place) OVER word // {wide} AS least, min(rank * {wide} + place) OVER word % {wide} AS leftmost,
                       coalesce(lag(rank) OVER upto, {never}) AS before, coalesce(lag(unruly) OVER upto, false) AS unruly_before,
                       max(CASE WHEN token IS DISTINCT FROM previous THEN place END) OVER upto AS first
                FROM (
                    SELECT s.*, coalesce(m.rank, {never}) AS rank, coalesce(m.unruly, false) AS unruly
                    FROM (
                        SELECT word, pos, token, step, lead(token) OVER w AS following, lag(token) OVER w AS previous, row_number() OVER w AS place
                        FROM state WHERE more AND step < {steps} WINDOW w AS (PARTITION BY word ORDER BY pos)
                    ) s LEFT JOIN merges m ON m.a = s.token AND m.b = s.following
                ) WINDOW upto AS (PARTITION BY word ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                         word AS (PARTITION BY word ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
            )
        ) WHERE NOT absorbed
    )
    SELECT word, pos, token, more FROM state WHERE NOT more OR step = {steps}
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens of a .tiktoken file with their ranks, which are their ids."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _made_of(token: bytes, rank: int, ranks: dict[bytes, int]) -> list[bytes]:
    """What a token's bytes merge to by lower ranks alone."""
    parts = [bytes([b]) for b in token]
    while len(parts) > 2:
        best, i = min((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if best >= rank:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """a, b, rank, unruly: pairs of tokens that are a token together.

    If every token merges from lower ranks to exactly two parts, ranks never fall while a word is contracted, and a pair of
    other parts of the same bytes never stands side by side: those two parts are the token's only pair. Otherwise all
    splits are kept, and tokens that take part in a pair of lower rank than their own are unruly."""
    longer = [(t, r) for t, r in ranks.items() if len(t) > 1]
    made = [(_made_of(t, r, ranks), r) for t, r in longer]
    if all(len(parts) == 2 and parts[0] in ranks and parts[1] in ranks for parts, _ in made):
        pairs = [(ranks[a], ranks[b], r) for (a, b), r in made]
    else:
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in longer for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
    unruly = {x for a, b, r in pairs for x in (a, b) if x > r}
    a, b, r = zip(*pairs, strict=True) if pairs else ((), (), ())
    return pa.table({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "rank": pa.array(r, pa.int64()), "unruly": pa.array([x in unruly for x in r], pa.bool_())})


class Database:
    """The tables of a vocabulary and of the words met so far, in a DuckDB of one thread."""

    def __init__(self, vocabulary: pa.Table, merges: pa.Table) -> None:
        # Nothing spills: a worker's disk is not used.
        self.duck = duckdb.connect(config={"threads": 1, "temp_directory": "", "preserve_insertion_order": False})
        for name, table in (("vocabulary", vocabulary), ("merges", merges)):
            self.duck.register("given", table)
            self.duck.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.duck.unregister("given")
        self.duck.execute("CREATE TABLE bytes AS SELECT digits, id FROM vocabulary WHERE octet_length(raw) = 1")
        self.forget()

    def forget(self) -> None:
        self.duck.execute("CREATE OR REPLACE TABLE known (word VARCHAR, ids INTEGER[])")
        self.words = 0

    def _one(self, sql: str) -> int:
        return self.duck.execute(sql).fetchall()[0][0] or 0

    def learn(self) -> None:
        """Put the words of `words` (code, word) that are not known yet into `known`."""
        run = self.duck.execute
        run("CREATE OR REPLACE TEMP TABLE new AS SELECT code, word, encode(word) AS raw FROM words ANTI JOIN known USING (word)")
        run("INSERT INTO known SELECT word, [id] FROM new JOIN vocabulary USING (raw)")
        run("""CREATE OR REPLACE TEMP TABLE fresh AS
               SELECT code AS word, pos, id AS token
               FROM (SELECT code, unnest(regexp_extract_all(hex(raw), '..')) AS digits, unnest(range(octet_length(raw))) AS pos FROM new ANTI JOIN vocabulary USING (raw))
               JOIN bytes USING (digits)""")
        run(CONTRACT_SHORT.format(long=LONG, wide=WIDE))
        run(f"CREATE OR REPLACE TEMP TABLE fresh AS SELECT * FROM fresh SEMI JOIN (SELECT word FROM fresh GROUP BY word HAVING count(*) > {LONG}) USING (word)")
        run("CREATE OR REPLACE TEMP TABLE done (word INTEGER, pos BIGINT, token INTEGER)")
        while rows := self._one("SELECT count(*) FROM fresh"):
            run(CONTRACT_LONG.format(never=NEVER, wide=WIDE, steps=max(1, min(STEPS, STEP_ROWS // rows))))
            run("INSERT INTO done SELECT word, pos, token FROM reached WHERE NOT more")
            run("CREATE OR REPLACE TEMP TABLE fresh AS SELECT word, pos, token FROM reached WHERE more")
        run("INSERT INTO merged SELECT word, list(token ORDER BY pos) FROM done GROUP BY word")
        run("INSERT INTO known SELECT n.word, m.ids FROM merged m JOIN new n ON n.code = m.word")
        self.words += self._one("SELECT count(*) FROM new")

    def given_ids(self, ids: pa.Array) -> None:
        """Put lists of ids where `encode` leaves its own."""
        self.duck.register("given", pa.table({"row": pa.array(np.arange(len(ids))), "ids": ids}))
        self.duck.execute("CREATE OR REPLACE TEMP TABLE encoded AS SELECT row, coalesce(ids, []::INTEGER[]) AS ids FROM given")
        self.duck.unregister("given")

    def encode(self, texts: pa.Array) -> None:
        """Leave `encoded` (row, ids), a row for each text by its place."""
        run = self.duck.execute
        self.duck.register("given", pa.table({"row": pa.array(np.arange(len(texts))), "text": texts}))
        run("CREATE OR REPLACE TEMP TABLE texts AS SELECT row, coalesce(text, '') AS text FROM given")
        self.duck.unregister("given")
        mark = next(m for m in map(chr, MARKS) if not self._one(f"SELECT count(*) FROM texts WHERE contains(text, '{m}')"))
        run(f"""CREATE OR REPLACE TEMP TABLE occurrences AS
                SELECT row, unnest(ws) AS word, unnest(range(len(ws))) AS pos
                FROM (SELECT row, regexp_extract_all({MARKED.replace('MARK', mark)}, $${WORD.replace('MARK', mark)}$$) AS ws FROM texts)""")
        run(f"CREATE OR REPLACE TEMP TABLE words AS SELECT word, CAST(row_number() OVER () AS INTEGER) AS code FROM occurrences WHERE word <> '{mark}' GROUP BY word")
        if self.words > REMEMBERED:
            self.forget()
        self.learn()
        run("""
            CREATE OR REPLACE TEMP TABLE encoded AS
            WITH coded AS (SELECT word, ids FROM words JOIN known USING (word)),
            found AS (SELECT row, flatten(list(ids ORDER BY pos)) AS ids FROM occurrences JOIN coded USING (word) GROUP BY row)
            SELECT row, coalesce(ids, []::INTEGER[]) AS ids FROM texts LEFT JOIN found USING (row)""")

    def decode(self, wanted: bool = True) -> None:
        """Leave `decoded` (row, raw) of the ids of `encoded`: their bytes in order; empty if not wanted."""
        if not wanted:
            self.duck.execute("CREATE OR REPLACE TEMP TABLE decoded (row BIGINT, raw BLOB)")
            return
        self.duck.execute("""
            CREATE OR REPLACE TEMP TABLE decoded AS
            WITH tokens AS (SELECT row, unnest(ids) AS id, unnest(range(len(ids))) AS pos FROM encoded),
            found AS (SELECT row, string_agg(CASE WHEN digits IS NULL THEN error('an id outside the vocabulary: ' || id) ELSE digits END, '' ORDER BY pos) AS digits FROM tokens LEFT JOIN vocabulary USING (id) GROUP BY row)
            SELECT e.row, unhex(coalesce(digits, '')) AS raw FROM encoded e LEFT JOIN found USING (row)""")

    def fetch(self, columns: str) -> pa.Table:
        """Columns of `e` (row, ids) and, once decoded, of `d` (row, raw), in the order of rows."""
        return self.duck.sql(f"SELECT {columns} FROM encoded e LEFT JOIN decoded d USING (row) ORDER BY row").to_arrow_table()


#: This worker's database, by its vocabulary.
_database: dict[str, Database] = {}


def _database_of(key: str, vocabulary: pa.Table, merges: pa.Table) -> Database:
    if key not in _database:
        _database.clear()
        _database[key] = Database(vocabulary, merges)
    return _database[key]


def _runs(column: pa.Array, chars: int) -> Iterator[tuple[int, int]]:
    """Where runs of rows start, and their numbers: at most TOGETHER rows and about `chars` bytes, a larger row alone."""
    lengths = np.array(pc.fill_null(pc.binary_length(column) if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else pc.list_value_length(column), 0))
    at = 0
    while at < len(lengths):
        sums = np.cumsum(lengths[at : at + TOGETHER])
        n = max(1, int(np.searchsorted(sums, chars, side="right")))
        yield at, n
        at += n


def _mapped(df: DataFrame, path: str, column: str, fields: str, columns: str) -> DataFrame:
    """doc_id and `columns` (SQL over encoded and decoded rows) of each row; `column` is text, or ids."""
    ranks = read_ranks(path)
    vocabulary = pa.table({"id": pa.array(ranks.values(), pa.int32()), "raw": pa.array(ranks.keys(), pa.binary()), "digits": pa.array([t.hex().upper() for t in ranks], pa.string())})
    key = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    shared = df.sparkSession.sparkContext.broadcast((key, vocabulary, merge_table(ranks)))  # a size set by the vocabulary
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        database = _database_of(*shared.value)
        for batch in batches:
            given = batch.column(column)
            for at, n in _runs(given, CHARS):
                part = given.slice(at, n)
                if column == "text":
                    database.encode(part)
                else:
                    database.given_ids(part.cast(pa.list_(pa.int32())))
                database.decode("raw" in columns)
                found = database.fetch(columns).combine_chunks()
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, n), *(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in found.columns)], ["doc_id", *names])

    id_type = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", column).mapInArrow(run, f"doc_id {id_type}, {fields}")


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (an array of token ids) of each row of `docs`."""
    return _mapped(docs, path, "text", "ids array<int>", "ids")


def decode_documents(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and raw (the bytes of the text) of each row of `tokens` (doc_id, ids); null ids give no bytes."""
    return _mapped(tokens, path, "ids", "raw binary", "raw")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row of `docs`, encoded and decoded in one pass."""
    return _mapped(docs, path, "text", "n_tokens long, ids_sha256 string, decoded_sha256 string", "len(ids) AS n_tokens, sha256(array_to_string(ids, ' ')) AS ids_sha256, sha256(raw) AS decoded_sha256")
