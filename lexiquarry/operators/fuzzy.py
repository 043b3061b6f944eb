"""Fuzzy terms by deletion neighbourhoods.

Two words within d edits have a common rest after at most d letters are removed from each, so candidates meet on equal
rests, never on word lengths. An edit is a letter added, removed or changed, or two neighbours swapped; no place is edited
twice (optimal string alignment). Up to two edits are supported, as in ranked search servers.

Only the first `PREFIX` letters lose letters, so a word of any length has few rests. Nothing is missed: of two words with a
common rest, the longest common beginning of what is left of both prefixes is a rest of both, with no more letters removed.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lexiquarry.session import local_table

# Expansions of one term, and edits at most.
MAX_EXPANSIONS = 50
MAX_EDITS = 2
# A longer prefix has more rests (15, 20 and 27 a word for 5, 6 and 7 letters), a shorter one more words for each of them.
PREFIX = 6


def allowed_edits(fuzziness: str | int, term: str) -> int:
    """Edits allowed for a term; AUTO gives 0 up to 2 letters, 1 up to 5, then 2."""
    if fuzziness != "AUTO":
        if not 0 <= int(fuzziness) <= MAX_EDITS:
            raise ValueError(f"fuzziness {fuzziness}: at most {MAX_EDITS} edits")
        return int(fuzziness)
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


def fuzzy_terms(spark: SparkSession, rows: list[dict], keys: Sequence[tuple] = ()) -> DataFrame:
    """Query terms with their edit limits as input of `fuzzy_expand`."""
    return local_table(spark, rows, pa.schema(
        [*keys, ("field", pa.string()), ("query_term", pa.string()), ("max_edits", pa.int32())]))


def _part(word: Column, first: Column | int, length: Column | int) -> Column:
    return F.substring(word, F.lit(first) if isinstance(first, int) else first,
                       F.lit(length) if isinstance(length, int) else length)


def _with_rests(words: DataFrame, name: str) -> DataFrame:
    """A row with `removed` and `key` for each way to leave out up to two letters of the beginning of the word in column `name`.

    Rows rather than arrays, so that the work is compiled. Of equal letters in a row the first goes, as the rest is the same.
    """
    words = words.withColumn("__start", _part(F.col(name), 1, PREFIX))
    word = F.col("__start")
    n, i, j = F.length(word), F.col("__i"), F.col("__j")

    def first_of_its_kind(at: Column) -> Column:
        return (at == 1) | (_part(word, at, 1) != _part(word, at - 1, 1))

    one = words.withColumn("__i", F.explode(F.sequence(F.lit(0), n))).where((i == 0) | first_of_its_kind(i))
    second = F.when((i > 0) & (i < n), F.concat(F.array(F.lit(0)), F.sequence(i + 1, F.greatest(n, i + 1)))).otherwise(F.array(F.lit(0)))
    two = one.withColumn("__j", F.explode(second)).where((j == 0) | (j == i + 1) | first_of_its_kind(j))
    rest = F.when(i == 0, word).when(j == 0, F.concat(_part(word, 1, i - 1), _part(word, i + 1, n))).otherwise(
        F.concat(_part(word, 1, i - 1), _part(word, i + 1, j - i - 1), _part(word, j + 1, n)))
    return two.withColumns({"removed": (i > 0).cast("int") + (j > 0).cast("int"), "key": F.xxhash64(rest)}).drop("__start", "__i", "__j")


def neighbour_keys(vocabulary: DataFrame) -> DataFrame:
    """(field, term, key, removed): every key under which a term can be found, from (field, term, …)."""
    return _with_rests(vocabulary.select("field", "term"), "term").select("field", "term", "key", "removed")


def query_keys(terms: DataFrame) -> DataFrame:
    """(field, query_term, max_edits, key, asked_removed) of distinct query terms."""
    found = _with_rests(terms.select("field", "query_term", "max_edits").distinct(), "query_term")
    return found.where(F.col("removed") <= F.col("max_edits")).withColumnRenamed("removed", "asked_removed")


def _letters(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: _part(word, i, 1))


def alignment_distance(a: Column, b: Column) -> Column:
    """Optimal string alignment distance of two words if it is at most MAX_EDITS, else something greater.

    Row by row of the table of distances, of which only the cells near the diagonal matter: cell number k of row i
    stands for i letters of `a` and i + k - MAX_EDITS of `b`.
    """
    cells, far = list(range(2 * MAX_EDITS + 1)), F.lit(1000)
    kind = "struct<before:array<int>,last:array<int>,letter:string,i:int>"
    nothing = F.array(*[F.when(F.length(b) >= k - MAX_EDITS, max(k - MAX_EDITS, 0)).otherwise(far) if k >= MAX_EDITS else far for k in cells])
    start = F.struct(F.array(*[far] * len(cells)).alias("before"), nothing.alias("last"), F.lit("").alias("letter"),
                     F.lit(0).alias("i")).cast(kind)

    def row(state: Column, letter: Column) -> Column:
        i = state["i"] + 1

        def cell(done: Column, k: Column) -> Column:
            j = i + k - MAX_EDITS
            here = _part(b, j, 1)
            swapped = F.when((j > 1) & (letter == _part(b, j - 1, 1)) & (state["letter"] == here), F.get(state["before"], k) + 1)
            changed = F.get(state["last"], k) + F.when(letter == here, 0).otherwise(1)
            value = (F.when((j < 0) | (j > F.length(b)), far).when(j == 0, i).otherwise(
                F.least(F.get(done, k - 1) + 1, F.get(state["last"], k + 1) + 1, changed, swapped)))
            return F.concat(done, F.array(value))

        filled = F.aggregate(F.array(*map(F.lit, cells)), F.array().cast("array<int>"), cell)
        return F.struct(state["last"].alias("before"), filled.alias("last"), letter.alias("letter"), i.alias("i")).cast(kind)

    last = F.aggregate(_letters(a), start, row)["last"]
    return F.coalesce(F.get(last, F.length(b) - F.length(a) + MAX_EDITS), far)


def edit_distance(a: Column, b: Column) -> Column:
    """Optimal string alignment distance up to two; what is more apart gives more than two, or null.

    Without swaps it is the built-in distance. A swap leaves the letters of a word as they are, so words with too
    many letters of their own need no second look.
    """
    plain = F.levenshtein(a, b, 2 * MAX_EDITS)
    one, other = _letters(a), _letters(b)
    apart = F.size(F.array_except(one, other)) + F.size(F.array_except(other, one))
    no_swap = (plain <= 1) | (apart > F.when(plain == 3, 2).otherwise(0))
    return F.when(plain < 0, F.lit(None)).when(no_swap, plain).otherwise(alignment_distance(a, b))


def like_in_length(candidates: DataFrame) -> DataFrame:
    """Words that share a beginning may differ more in length than edits can make up for; these go."""
    return candidates.where(F.abs(F.length("term") - F.length("query_term")) <= F.col("max_edits"))


def nearest_terms(candidates: DataFrame, terms: DataFrame, max_expansions: int = MAX_EXPANSIONS) -> DataFrame:
    """(*terms, term, dist, weight): the best candidates of each query term.

    `candidates` has (field, query_term, max_edits, term). Ties go to the alphabetically first term. The weight is
    1 - dist / length of the shorter word.
    """
    keys = terms.columns
    pairs = like_in_length(candidates).select("field", "query_term", "max_edits", "term").distinct()
    near = (pairs.withColumn("dist", edit_distance(F.col("query_term"), F.col("term")))
            .where(F.col("dist") <= F.col("max_edits")))
    best = W.partitionBy("field", "query_term", "max_edits").orderBy("dist", "term")
    shorter = F.least(F.length("query_term"), F.length("term"))
    kept = (near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= max_expansions)
            .select("field", "query_term", "max_edits", "term", F.col("dist").cast("long").alias("dist"),
                    (1 - F.col("dist") / shorter).alias("weight")))
    return terms.join(kept, ["field", "query_term", "max_edits"]).select(*keys, "term", "dist", "weight")


def meet(neighbours: DataFrame, terms: DataFrame) -> DataFrame:
    """(field, query_term, max_edits, term) that share a key; a pair may come several times."""
    return (neighbours.join(query_keys(terms), ["field", "key"]).where(F.col("removed") <= F.col("max_edits"))
            .select("field", "query_term", "max_edits", "term"))


def fuzzy_expand(vocabulary: DataFrame, terms: DataFrame, max_expansions: int = MAX_EXPANSIONS) -> DataFrame:
    """Index terms near each query term: (*terms, term, dist, weight), best `max_expansions` each.

    `terms` has (field, query_term, max_edits) plus any key columns. A stored index keeps the keys of its vocabulary;
    here they are made on the way.
    """
    return nearest_terms(meet(neighbour_keys(vocabulary), terms), terms, max_expansions)
