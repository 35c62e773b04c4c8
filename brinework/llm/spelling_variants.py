"""Spelling variant grouping: words one edit apart, found by a frontier that walks tries as tables.

The words of each length have a trie, read from the front, and another one of the words read from
behind. A node is named by its letters, the side and the length of its words, so names are exact.
An edit lies in one half of its word: words keep their first half on the side where the edit comes
later, so that walks begin below the nodes where tries are dense. States (word, text, side) begin
where a letter of the word is left out, or another one of its node takes its place; the text is what
the other word would be. An inserted letter is the other word's left-out one, so pairs are found
once and turned round at the end.

A level takes ``STRIDE`` letters: the states that begin among them and those of the levels before
are joined with the nodes that end them, and only states that some word continues live on; one
whose text is at its end there has found its word. A level is one small plan of its own, as many
levels in a plan cost the driver more memory than the tables do.

Words longer than ``LONGEST`` letters, whose prefixes would grow with the square of their length,
meet by a hash of all but one of ``PARTS`` parts instead, as one edit leaves the others alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinework.llm.common import checkpoint, free_names, split_join

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = "[A-Za-zÀ-ÿ]+"
MIN_LETTERS, MIN_COUNT, DAMAGE = 5, 3, 97
#: Letters of the longest word in the trie; longer ones meet by all of their parts but one.
LONGEST, PARTS = 20, 64
#: Letters of a level of the walk.
STRIDE = 5


def word_counts(docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, damage: int = DAMAGE) -> DataFrame:
    """(word, n) of the runs of letters of all texts; a run whose checksum with its document's id is divisible by ``damage`` loses a letter.

    A null text has no words; a null id counts as an empty one.
    """
    id_, run, h = free_names(docs, "id", "run", "h")
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias(id_), F.explode(F.regexp_extract_all("text", F.lit(f"({RUN})"), F.lit(1))).alias(run))
    # the shorter runs can only become shorter; only A to Z have another case in a run of ASCII
    small = F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))
    marked = runs.where(F.length(run) >= min_letters).withColumn(run, small).withColumn(h, F.crc32(F.concat_ws(":", F.col(id_), F.col(run)).cast("binary")))
    at = F.pmod(F.col(h), F.length(run)).cast("int")
    cut = F.concat(F.substring(run, 1, at), F.substring(F.col(run), at + 2, F.length(run)))
    words = marked.select(F.when(F.col(h) % damage == 0, cut).otherwise(F.col(run)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where((F.length("word") >= min_letters) & (F.col("n") >= min_count))


def sides(words: DataFrame) -> DataFrame:
    """(word, text, side, begins): every word from the front and from behind, with the first place whose edits are found on that side."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")
    both = F.array(
        F.struct(F.col("word").alias("text"), F.lit(">").alias("side"), half.alias("begins")),
        F.struct(F.reverse("word").alias("text"), F.lit("<").alias("side"), (size - half).alias("begins")),
    )
    return words.select("word", F.explode(both).alias("s")).select("word", "s.*")


def _node(letters: Column | int) -> Column:
    """The name of the node that so many letters of ``text`` lead to, or all if it has fewer: a text at its end is a whole word there."""
    return F.concat(F.substring("text", F.lit(1), F.lit(letters) if isinstance(letters, int) else letters), "side", F.length("text").cast("string"))


def edited(texts: DataFrame, low: int, high: int) -> DataFrame:
    """(word, text, side): the states that begin at the places from ``low`` to before ``high``: a letter left out, or a greater one of its node in its place."""
    size, at = F.length("text"), F.col("at")
    first, last = F.greatest("begins", F.lit(low)), F.least(size, F.lit(high)) - 1
    places = texts.where(first <= last).withColumn("at", F.explode(F.sequence(first, last))).withColumn("mine", F.substring("text", at + 1, F.lit(1)))
    head, tail = F.substring("text", F.lit(1), at), F.substring("text", at + 2, size)
    # of equal letters in a row one is left out, as the others give the same word: the first, or the
    # first behind the middle if the row lies across it
    once = (F.col("mine") != F.substring("text", at, F.lit(1))) | ((at == F.col("begins")) & (F.col("side") == ">"))
    shorter = places.where(once).select("word", F.concat(head, tail).alias("text"), "side")
    own = places.withColumn("node", _node(at))
    forks = own.groupBy("node").agg(F.collect_set("mine").alias("letters")).where(F.size("letters") > 1)
    others = split_join(own, forks, "node").withColumn("letter", F.explode("letters")).where(F.col("letter") > F.col("mine"))
    return shorter.unionByName(others.select("word", F.concat(head, "letter", tail).alias("text"), "side"))


def trie_neighbours(words: DataFrame, stride: int = STRIDE) -> DataFrame:
    """(word, other): pairs one edit apart, each once: the other word is one letter shorter, or as long with a greater letter in one place."""
    top = words.agg(F.max(F.length("word"))).first()[0]
    if not top:
        return words.select("word", F.col("word").alias("other")).where("false")
    texts, size, found, alive = sides(words), F.length("text"), [], None
    for d in range(0, top, stride):
        to = d + stride
        front = edited(texts, d, to)
        if alive is not None:
            front = front.unionByName(alive)
        # the words that end before this level have been found by now
        nodes = texts.where(size >= d).select(_node(to).alias("node")).distinct()
        met = checkpoint(split_join(front.withColumn("node", _node(to)), nodes, "node").select("word", "text", "side"))
        ended = met.where(size <= to)
        found.append(ended.select("word", F.when(F.col("side") == "<", F.reverse("text")).otherwise(F.col("text")).alias("other")))
        alive = met.where(size > to)
    return reduce(DataFrame.unionByName, found)


def long_neighbours(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """(word, other): the same pairs among words too long for the trie, met by all of the shorter word but one of its parts."""
    def keys(length: Column) -> Column:
        part = F.ceil(length / parts).cast("int")
        rest = lambda k: F.xxhash64(F.substring("word", F.lit(1), k * part), F.right("word", F.greatest(length - (k + 1) * part, F.lit(0))))
        return F.transform(F.sequence(F.lit(0), F.ceil(length / part).cast("int") - 1), lambda k: F.struct(length.alias("m"), k.alias("k"), rest(k).alias("rest")))

    size = F.length("word")
    a = words.select("word", F.explode(F.concat(keys(size), keys(size - 1))).alias("key"))
    b = words.select(F.col("word").alias("other"), F.explode(keys(size)).alias("key"))
    once = (F.length("other") < size) | (F.col("word") < F.col("other"))
    return a.join(b, "key").where(once & (F.levenshtein("word", "other", 1) == 1)).select("word", "other").distinct()


def neighbours(words: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(word, other) of all pairs of words one inserted, deleted or replaced letter apart, in both directions."""
    size = F.length("word")
    short = trie_neighbours(words.where(size <= longest).select("word"))
    # of a pair with a word beyond the trie, the other has the trie's longest length at least
    long = long_neighbours(words.where(size >= longest).select("word")).where(F.length("word") > longest)
    once = short.unionByName(long)
    return once.unionByName(once.select(F.col("other").alias("word"), F.col("word").alias("other")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form): the last word that the forms lead to.

    Each round doubles the way, so the rounds grow with the logarithm of the longest way.
    """
    up = checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        far = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = up.join(far, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        jumped = checkpoint(jumped)
        up = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return up


def group_variants(
    docs: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, damage: int = DAMAGE, ratio: int = 2, longest: int = LONGEST
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts.

    ``form`` is the most frequent word one edit away (of equals the first), if it occurs ``ratio``
    times as often at least; ``root`` is the last word that forms lead to. Null and empty texts
    have no words, repeated documents count each, a document of any length is read whole, a null
    id counts as an empty one, other columns are not read, and an empty table gives an empty result.
    """
    words = checkpoint(word_counts(docs, min_letters, min_count, damage))
    near = neighbours(words, longest)
    counts = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = near.join(counts, "other").groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("o"), "other")).alias("b"))
    often = -F.col("b.o") >= ratio * F.col("n")
    found = words.join(best, "word", "left").select(
        "word", F.when(often, F.col("b.other")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(often, -F.col("b.o")).alias("form_n")
    )
    found = checkpoint(found)
    last = roots(found.where("form is not null"))
    return found.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
