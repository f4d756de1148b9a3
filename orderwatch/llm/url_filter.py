"""URL filter: rules first, then naive Bayes over the words of the host and of the path.

Hosts run words together. Each run of letters in a host is split by Viterbi decoding under a unigram model, whose
counts come from the text of all pages; candidates reach the counts by a join, so the model may be of any size.
Naive Bayes counts the words of every URL that a seed list marks or does not mark, and judges URLs that no
rule decides. The most frequent words of URLs go to every task; the others reach their URLs by a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderwatch.llm.common import cut, most_frequent

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The most words whose odds are sent to every task, and the most letters of one; the others are joined.
SENT_WORDS = 1 << 16
SENT_LETTERS = 64
#: Words of a host or path that mark a URL as an example of what to block.
SEED_SHARE = 1e-4
SEEDS = tuple(
    "ads adult bet bets bonus casino cheap escort jackpot loan loans payday pills poker porn sex slots spam viagra xxx".split()
)


@dataclass(frozen=True)
class Rule:
    """A host with its subdomains and the start of a path, as `host/path`, and what to do with such URLs."""

    text: str
    verdict: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        at_host = (host == name) | host.endswith(f".{name}")
        return at_host & path.startswith(slash + rest)


# The rules of the contract.
RULES = (
    Rule("com/", "allow"),
    Rule("example.com/en/", "block"),
    Rule("www.example.com/en/", "allow"),
    Rule("net/es/", "block"),
    Rule("net/fr/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path; both empty for null and where there is no `://`."""
    rest = F.coalesce(F.when(url.contains("://"), F.element_at(F.split(url, "://", 2), 2)), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Iterable[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = rule.fits(host, path)
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def word_counts(text: Column, rows: DataFrame) -> DataFrame:
    """How often each word of letters a-z, of any length, stands in a column of marked-up text."""
    plain = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]*>", " "))
    words = rows.select(F.explode(F.split(plain, "[^a-z]+")).alias("word"))
    return words.filter(F.length("word") > 0).groupBy("word").count()


def with_seeds(counts: DataFrame, seeds: Iterable[str]) -> DataFrame:
    """The counts with every seed as a word, at SEED_SHARE of all words at least."""
    total = counts.agg(F.sum("count")).first()[0] or 0
    least = [(s, max(1, int(total * SEED_SHARE))) for s in seeds]
    known = counts.sparkSession.createDataFrame(least, "word string, count long")
    return counts.unionByName(known).groupBy("word").agg(F.sum("count").alias("count"))


def split_words(run: str, starts: list[int], words: list[str], counts: list[int], total: int) -> list[str]:
    """The most likely words of a run of letters. A stretch without a known word costs as an unseen word of its
    length; ties go to the longer last word. The work grows with the letters and the known words among them."""
    known: dict[int, list[tuple[int, float]]] = {}
    for begin, word, count in zip(starts, words, counts, strict=True):
        known.setdefault(begin + len(word), []).append((begin, math.log(count / total)))
    unseen, letter = -math.log(total + 1), math.log(10)
    best, cut_at = [0.0], [0]
    # Where the best unseen word would begin: each letter of it costs the same, so it is the same up to any end.
    gain, opening = 0.0, 0
    for end in range(1, len(run) + 1):
        options = [(gain + unseen - end * letter, -opening)]
        options += [(best[begin] + chance, -begin) for begin, chance in known.get(end, ())]
        score, begin = max(options)
        best.append(score)
        cut_at.append(-begin)
        if score + end * letter > gain:
            gain, opening = score + end * letter, end
    out, end = [], len(run)
    while end:
        out.append(run[cut_at[end] : end])
        end = cut_at[end]
    return out[::-1]


def segmented_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """Per distinct host: host and `words`, its runs of letters split into words."""
    total = counts.agg(F.sum("count")).first()[0] or 1
    parts = hosts.select("host").distinct().select("host", F.posexplode(F.regexp_extract_all("host", F.lit("[a-z]+"), F.lit(0))))
    runs = parts.select(F.col("col").alias("run")).distinct()
    begins = runs.select("run", F.explode(F.sequence(F.lit(0), F.length("run") - 1)).alias("begin"))
    # Only stretches as long as some word are looked up.
    lengths = sorted(row.size for row in counts.select(F.length("word").alias("size")).distinct().collect())
    sizes = F.filter(F.lit(lengths).cast("array<int>"), lambda size: size <= F.length("run") - F.col("begin"))
    pieces = begins.select("run", "begin", F.explode(sizes).alias("size"))
    pieces = pieces.select("run", "begin", F.col("run").substr(F.col("begin") + 1, F.col("size")).alias("word"))
    known = pieces.join(counts, "word").groupBy("run").agg(
        F.sort_array(F.collect_list(F.struct("begin", "word", "count"))).alias("known")  # bounded by the run's length
    )

    @F.pandas_udf("array<string>")
    def split(run: pd.Series, begin: pd.Series, word: pd.Series, count: pd.Series) -> pd.Series:
        columns = zip(run, begin, word, count, strict=True)
        return pd.Series([split_words(r, list(b), list(w), list(c), total) for r, b, w, c in columns])

    empty = F.array().cast("array<struct<begin:int,word:string,count:bigint>>")
    all_runs = runs.join(known, "run", "left").withColumn("known", F.coalesce("known", empty))
    words = all_runs.select("run", split("run", "known.begin", "known.word", "known.count").alias("words"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "words")))
    return (
        parts.withColumnRenamed("col", "run")
        .join(words, "run")
        .groupBy("host")
        .agg(F.flatten(F.transform(ordered, lambda x: x["words"])).alias("words"))
    )


@dataclass
class NaiveBayes:
    """Log odds for blocking: of the classes, and of the words that go to every task."""

    prior: float
    words: dict[str, float]

    def judge(self, words: Iterable[str]) -> tuple[float, list[str]]:
        """The odds of the words known here, with those of the classes, and the other words."""
        words = list(words)
        return self.prior + sum(self.words.get(w, 0.0) for w in words), sorted(w for w in words if w not in self.words)


def fit_naive_bayes(examples: DataFrame, sent: int = SENT_WORDS) -> tuple[NaiveBayes, DataFrame | None]:
    """Multinomial counts with one added to each word, from `words` (array) and `bad` (boolean) of all examples.

    Returns the model with the `sent` most frequent words, and the odds of the others: word, odds; None without others.
    """
    bad = F.col("bad").cast("long")
    urls = examples.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(bad), F.lit(0)).alias("bad")).first()
    each = examples.select(bad.alias("bad"), F.explode("words").alias("word"))
    counts = cut(each.groupBy("word").agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n")))
    all_ = counts.agg(F.count(F.lit(1)).alias("words"), F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    share = lambda n, of: F.log((n + 1) / F.lit((of or 0) + all_.words + 1))
    odds = share(F.col("bad"), all_.bad) - share(F.col("n") - F.col("bad"), (all_.n or 0) - (all_.bad or 0))
    table = counts.select("word", "n", odds.alias("odds"))
    short = most_frequent(table.filter(F.length("word") <= SENT_LETTERS), sent).select("word", "odds")
    known = {row.word: row.odds for row in short.collect()}  # at most `sent` short words
    model = NaiveBayes(math.log((urls.bad + 1) / (urls.n - urls.bad + 1)), known)
    if len(known) == all_.words:
        return model, None
    return model, table.join(F.broadcast(cut(short.select("word"))), "word", "left_anti").select("word", "odds")


def judge_urls(
    pages: DataFrame,
    rules: Iterable[Rule] = RULES,
    seeds: Iterable[str] = SEEDS,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
    sent: int = SENT_WORDS,
) -> DataFrame:
    """Per row: page_id, host, path, rule, verdict, and the log odds for blocking.

    A URL that is null or has no `://` has an empty host and path, so it falls to the method without words: it is
    allowed, as are even odds. Repeated rows are judged one by one; other columns are neither read nor returned.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    counts = cut(with_seeds(cut(word_counts(F.col(text_col), pages)), seeds))
    hosts = cut(segmented_hosts(urls, counts))
    of_path = F.regexp_extract_all(F.lower("path"), F.lit("[a-z]+|[0-9]+"), F.lit(0))
    worded = urls.join(hosts, "host", "left").withColumn(
        "words", F.concat(F.coalesce("words", F.array().cast("array<string>")), of_path)
    )
    marked = F.arrays_overlap("words", F.array(*[F.lit(s) for s in seeds]))
    model, others = fit_naive_bayes(worded.filter(F.size("words") > 0).select("words", marked.alias("bad")), sent)
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("odds double, others array<string>")
    def judged(words: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.judge(w) for w in words], columns=["odds", "others"])

    scored = worded.select("page_id", "host", "path", judged("words").alias("judged"), F.size("words").alias("n"))
    scored = scored.select("page_id", "host", "path", "n", F.col("judged.odds").alias("block_odds"), "judged.others")
    if others is not None:
        rare = scored.filter(F.size("others") > 0)
        added = rare.select("others").distinct().withColumn("word", F.explode("others")).join(others, "word")
        added = added.groupBy("others").agg(F.sum("odds").alias("added"))
        rare = rare.join(added, "others", "left").withColumn("block_odds", F.col("block_odds") + F.coalesce("added", F.lit(0.0)))
        scored = scored.filter(F.size("others") == 0).unionByName(rare.drop("added"))
    text, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when((F.col("n") > 0) & (F.col("block_odds") > 0), "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"), "block_odds"
    )
