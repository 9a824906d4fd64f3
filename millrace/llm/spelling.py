"""Spelling variants: words one edit apart, grouped under their commonest form.

The vocabulary is scanned as a sorted list.  For each word the rows of a banded edit matrix
are kept as a stack over the letters of the list's current word; the next word shares a
prefix with it (their LCP), so only the rows behind that prefix are computed.  Where every
cell of a row exceeds one edit, all following words with that prefix are skipped at once.

At scale the list is cut into ranges.  Two words one edit apart, the shorter of L letters,
agree on their first L // 2 letters or on their last L - L // 2, so each pair lies in one
range of words with the same beginning, of the list sorted forwards or of the list of
reversed words.  A range longer than ``RANGE_WORDS`` is cut again, exactly: there each word
goes to the ranges of itself with one letter of the differing half left out, in which at
most an alphabet of words can meet.  Every pair meets once in all.

Runs are counted in tasks before they are shuffled.  Null texts hold no words; a null id
counts as empty in the hash.  Repeated rows count again.  Extra columns are ignored, and an
empty table has no words.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from millrace.llm.common import bounded, durable

MIN_LETTERS = 6
MIN_COUNT = 5
ROOT_RATIO = 5  # a form is at least so many times as frequent as its variant
TYPO_EVERY = 199  # runs whose hash this divides lose a letter
RANGE_WORDS = 20_000
PENDING_WORDS = 100_000  # words counted in a task before they are passed on

FAR = 2  # more edits than allowed
BEYOND = "\U0010ffff"  # sorts behind every letter


def count_words(docs: DataFrame) -> DataFrame:
    """word, n: the words of at least MIN_LETTERS letters with at least MIN_COUNT occurrences."""
    bounded(docs.sparkSession)
    source = docs.select(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).alias("id"), docs["text"].alias("text"))
    # Shorter runs cannot become words of MIN_LETTERS letters.
    runs = re.compile(f"[a-zÀ-ÿ]{{{MIN_LETTERS},}}")

    def passed_on(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                lower = (text.as_py() or "").encode().lower().decode()  # of bytes: A-Z only
                start = zlib.crc32(f"{name}:".encode())
                for word, n in Counter(runs.findall(lower)).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % TYPO_EVERY == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                    total[word] += n
                if len(total) > PENDING_WORDS:
                    yield passed_on(total)
                    total = Counter()
        if total:
            yield passed_on(total)

    found = source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where((F.length("word") >= MIN_LETTERS) & (F.col("n") >= MIN_COUNT))


def shared_letters(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def neighbours(words: list[str]) -> Iterator[tuple[int, int]]:
    """Index pairs (i < j) of a sorted list of distinct words that are one edit apart."""
    lcp = [0, *map(shared_letters, words, words[1:])]
    total = len(words)
    for i in range(total - 1):
        query = words[i]
        size = len(query)
        # Row d of the matrix holds the edits from d letters of the list's word to d-1, d
        # and d+1 letters of the query.  The list is entered at the query itself.
        rows = [(FAR, 0, 1), *[(1, 0, 1)] * size]
        j = i + 1
        while j < total:
            word = words[j]
            depth = lcp[j]
            del rows[depth + 1 :]
            below, same, above = rows[depth]
            dead = False
            for d in range(depth + 1, len(word) + 1):
                letter = word[d - 1]
                # Cells outside of the query or of the band count as FAR.
                x = min(below + (letter != query[d - 2]), same + 1) if 2 <= d <= size + 1 else (min(FAR, same + 1) if d == 1 else FAR)
                y = min(same + (letter != query[d - 1]), above + 1, x + 1) if d <= size else FAR
                z = min(above + (letter != query[d]), y + 1) if d < size else FAR
                below, same, above = x, y, z
                rows.append((x, y, z))
                if x > 1 and y > 1 and z > 1:
                    dead = True
                    break
            if dead:
                j = bisect_right(words, word[:d] + BEYOND, j)
                continue
            end = size - len(word) + 1
            if 0 <= end <= 2 and rows[len(word)][end] == 1:
                yield i, j
            j += 1


def ranges(words: DataFrame) -> DataFrame:
    """The rows of both sorted lists: range, letters (of the shorter word), back, spelled, n."""
    size = F.length("word")
    cuts = []
    for shorter in (size, size - 1):
        half = F.floor(shorter / 2).cast("int")
        for back in (False, True):
            spelled = F.reverse("word") if back else F.col("word")
            same = (shorter - half) if back else half
            cuts.append(
                F.struct(shorter.alias("letters"), F.lit(back).alias("back"), spelled.alias("spelled"), same.cast("int").alias("same"))
            )
    listed = words.select(F.explode(F.array(*cuts)).alias("cut"), "n").select("cut.*", "n")
    listed = listed.where(F.col("letters") >= MIN_LETTERS).withColumn("start", F.expr("left(spelled, same)"))
    name = ["letters", "back", "start"]
    long = listed.groupBy(name).count().where(F.col("count") > RANGE_WORDS).select(*name, F.lit(True).alias("long"))
    spelled, same, letters = F.col("spelled"), F.col("same"), F.col("letters")
    at = F.sequence(same + 1, F.length(spelled))
    left_out = lambda mark: F.transform(at, lambda i: F.concat(F.substring(spelled, F.lit(1), i - 1), F.lit(mark), F.substring(spelled, i + 1, F.length(spelled))))
    # Equal lengths meet where the replaced letter is masked, unequal ones where the longer
    # word has lost the letter.  '.' and '+' are no letters, so the kinds of range stay apart.
    shorter = F.concat(left_out("."), F.array(F.concat(F.lit("+"), spelled)))
    longer = F.transform(F.array_distinct(left_out("")), lambda s: F.concat(F.lit("+"), s))
    finer = F.when(F.length(spelled) == letters, shorter).otherwise(longer)
    name_of = F.when(F.col("long"), finer).otherwise(F.array(F.col("start")))
    return listed.join(long, name, "left").select(F.explode(name_of).alias("range"), "letters", "back", "spelled", "n")


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, best: the near words' number, and (-n, word) of the most frequent one."""
    name = ["letters", "back", "range"]
    listed = ranges(words).repartition(*name).sortWithinPartitions(*name, "spelled")
    out = pa.schema([("word", pa.string()), ("near", pa.int64()), ("least", pa.int64()), ("form", pa.string())])

    def scanned(letters: int, back: bool, spelled: list[str], counts: list[int]) -> list[tuple]:
        half = letters // 2
        found: dict[int, list] = {}
        for i, j in neighbours(spelled):
            if len(spelled[i]) > letters and len(spelled[j]) > letters:
                continue  # a pair of the next length
            if back and spelled[i][-half:] == spelled[j][-half:]:
                continue  # met in the list sorted forwards
            for a, b in ((i, j), (j, i)):
                best = (-counts[b], spelled[b][::-1] if back else spelled[b])
                own = found.get(a)
                if own is None:
                    found[a] = [1, best]
                else:
                    own[0] += 1
                    own[1] = min(own[1], best)
        return [(spelled[a][::-1] if back else spelled[a], near, *best) for a, (near, best) in found.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, spelled, counts, rows = None, [], [], []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*name, "spelled", "n")]
            for letters, back, begin, word, n in zip(*columns):
                if (letters, back, begin) != current:
                    if len(spelled) > 1:
                        rows.extend(scanned(*current[:2], spelled, counts))
                    current, spelled, counts = (letters, back, begin), [], []
                spelled.append(word)
                counts.append(n)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)
                rows = []
        if len(spelled) > 1:
            rows = scanned(*current[:2], spelled, counts)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), out)], schema=out)

    partial = listed.mapInArrow(run, "word string, near long, least long, form string")
    return partial.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct("least", "form")).alias("best"))


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    A word's form is its most frequent near word (ties: the first in code-point order) if
    that is ROOT_RATIO times as frequent; its root is the end of the chain of forms.
    """
    words = durable(count_words(docs))
    most = words.agg(F.max("n").alias("n")).first() or Row(n=None)
    near = F.col("best.least")
    isform = -near >= ROOT_RATIO * F.col("n")
    judged = durable(
        words.join(near_words(words), "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(isform, F.col("best.form")).alias("form"),
            F.when(isform, -near).alias("form_n"),
        )
    )
    chain = judged.where("form is not null").select("word", F.col("form").alias("root"))
    # Counts grow ROOT_RATIO times with every step, so chains are short; each round doubles
    # the steps that a root is ahead.
    steps = int(math.log((most.n or MIN_COUNT) / MIN_COUNT, ROOT_RATIO)) + 1
    for _ in range(math.ceil(math.log2(steps))):
        ahead = chain.select(F.col("word").alias("root"), F.col("root").alias("next"))
        chain = durable(chain.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return judged.join(chain, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


#: The same in DuckDB: crc32 byte by byte, near words as equal words with one letter masked or left out.
ORACLE = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(1, 9)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT range AS b FROM range(256)))
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), counted AS (
  SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS x FROM runs WHERE length(run) >= 6 GROUP BY id, run
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(0, length(x) // 2),
      lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) AS h FROM counted, crc_table
), words AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
), letters AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words
), masked AS (
  SELECT word, n, substr(word, 1, i - 1) || '.' || substr(word, i + 1) AS k FROM letters
), shorter AS (
  SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS k FROM letters
), near AS (
  SELECT a.word, b.word AS other, b.n FROM masked a JOIN masked b ON a.k = b.k AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.k = w.word
  UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.k = w.word
), best AS (
  SELECT word, count(*) AS n_near, min({'a': -n, 'b': other}) AS best FROM near GROUP BY word
), judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best.a >= 5 * w.n THEN best.b END AS form,
    CASE WHEN -best.a >= 5 * w.n THEN -best.a END::BIGINT AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), chain AS (
  SELECT word, word AS root, 0 AS depth FROM judged
  UNION ALL SELECT c.word, j.form, depth + 1 FROM chain c JOIN judged j ON c.root = j.word WHERE j.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(root, depth) AS root FROM chain GROUP BY word
)
SELECT word, form, root, n, n_near, form_n FROM judged JOIN roots USING (word)
"""
