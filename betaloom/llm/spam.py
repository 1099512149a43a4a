"""Pages made of repeated keywords, bare link lists or product tags rather than sentences.

Two kinds of evidence are taken of every page and joined; neither knows a language.

Phrase evidence: the five-word shingles of all pages are exploded and their distinct hosts counted. A page's stitched share is
the part of its shingles that also stand on another host or again on the page itself, its repeated share the part that
repeats earlier ones, and its copied share the part of its distinct shingles that stand on MANY_HOSTS hosts or more.
Keywords are phrases of one word: the keyword share is the part of a page's words that a few words hold.

List-density evidence: a page is cut into segments at line ends and sentence ends. A segment that ends like a sentence is
prose, one with code, log or table marks is technical, the rest is list-like; density is the share of characters in
list-like segments and in the links inside them. Bare links, words, items between separators, the share of words held by
few (bare_keyed) and of short words are counted over the list-like segments.

A page is flagged if
- most of it is list-like, and this is borne out by many bare links, by many short items with few short words, by product
  marks, by a few words that hold most of it, or by a long run of words with no punctuation and hardly any short words;
  where its phrases are replicated, a third of these items and words is enough;
- a few words hold most of its prose as well (keywords dressed as sentences), and it is not mainly technical;
- nearly all of its phrases are replicated, most of them on the page itself, and it is not mainly technical; or
- it is long enough, and all its phrases stand on MANY_HOSTS hosts or more (one text posted everywhere).
Replication on a few other hosts alone is no verdict, as copies of genuine posts have it.

Defined results: null and empty texts have no evidence and are not flagged; a page without host is a host of its own;
rows that share an id are one page, with
the greatest evidence of its rows, so that a second delivery is no repetition; a page of fewer than five words has no shares of
phrases (null); texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from betaloom.shared import cut_lineage, sized

WORDS = 5  # words of a shingle
MOSTLY = 0.5  # share of a page that has to be list-like
SENTENCE_WORDS = 80  # words of a segment beyond which an end like a sentence's does not make it prose
FEW_LINKS = 6  # bare links that bear out a link list
FEW_WORDS = 20  # list-like words below which words bear out nothing
FEW_ITEMS, ITEM_WORDS, SHORT_LISTED = 10, 4, 0.35  # items that bear out a list of tags, their mean number of words and share of short words at most
PRODUCT_WORDS = 8  # words for each product mark, at most, in a list of products
KEY_PART, KEYED = 20, 0.4  # list-like words: each key word holds one in KEY_PART, all of them KEYED
DRESSED_PART = 6  # the same over prose as well, where genuine posts repeat themselves too
RUN_WORDS, SHORT_WORDS = 20, 0.2  # words of a run without punctuation, and its short words at most
STITCHED, FEWER = 0.8, 3  # replicated share that bears out lists with words and items fewer by this divisor
REPEATED, TECHNICAL = 0.6, 0.5  # repeated share that flags a stitched page, unless so much of it is technical
MANY_HOSTS, COPY_WORDS = 40, 10  # hosts of all phrases of a page of so many phrases that is posted everywhere

# --- fixed values: forms of links, markup, code, logs, tables and product marks ---------------------------------------
_MARK = "\x01"
_TLD = "com|net|org|info|biz|io|co|eu|de|fr|es|pt|uk|ru|cn|shop|online|site|xyz|example|test|invalid"
_INVISIBLE = r"[\u200b-\u200f\u2060\ufeff\u00ad]"
_BREAK = r"(?i)<(?:br|/?p|/?li|/?div|/?tr)\b[^<>]*+>"
_ANCHOR = r"(?i)<a\b(?=[^<>]*\bhref)[^<>]*+>|\[url=[^\[\]\n]*+\]"
_TAG = r"(?i)</?[a-z][^<>]*+>|\[/?url\]"
# a label of a domain has at most 63 letters, a domain at most 127 labels
_LINK = rf"(?i)(?:https?://|www\.)[^\s<>\"')\]]+|\b(?:[\p{{L}}\p{{N}}_-]{{1,63}}+\.){{1,126}}+(?:{_TLD})\b(?![\p{{L}}\p{{N}}_(.=])(?:/[^\s<>\"')\]]*)?"
_HINT = rf"(?i)://|www\.|\.(?:{_TLD})\b"  # what any link holds
_MARKDOWN = rf"!?\[([^\[\]\n]*+)\]\(\s*{_MARK}\s*\)"
_SEGMENT = r"\n|(?<=[.!?…。！？])\s+|(?<=[。！？])"
_END = rf"[.!?…。！？][\s\"'»”’)\]*_`~{_MARK}]*$"
_TECHNICAL = "|".join(
    (
        r"[(){}\[\]=$\\`]|<-|&[lg]t;|::|->|# |--\w|\s[<>]=?\s*\d|\breturn\b|\bSELECT\b",
        r"\b\d\d:\d\d:\d\d\b|\b(?:DEBUG|INFO|WARN|WARNING|ERROR|TRACE|FATAL)\b",
        r"\|.*\|.*\d|\d.*\|.*\||\t.*\t",
        r"[,;\t]-?\d+(?:\.\d+)?[,;\t]-?\d",
    )
)
_PRODUCT = r"[A-Za-z]{2,4}\W?\d{3,}|\b\d+-\w+\b|-\d+%|\d[.,]\d\d\b"
_ITEM = rf"\s*(?:[,;|/•·~+#»>{_MARK}]|\s[-–*]\s)\s*|\n|\s\s+"
_WORD, _GAP, _TWO_WORDS = r"[\p{L}\p{N}]+", r"[^\p{L}\p{N}]+", r"[\p{L}\p{N}][^\p{L}\p{N}]+[\p{L}\p{N}]"
# ------------------------------------------------------------------------------------------------------------------


def visible(text: Column) -> Column:
    """Text without zero-width characters and soft hyphens, which set words apart for a reader of bytes only."""
    return F.regexp_replace(F.replace(text, F.lit(_MARK), F.lit(" ")), _INVISIBLE, "")


def _ink(text: Column) -> Column:
    """Characters other than spaces, tabs and line ends."""
    for blank in (" ", "\n", "\t", "\r"):
        text = F.replace(text, F.lit(blank), F.lit(""))
    return F.length(text)


def _marks(text: Column) -> Column:
    return F.length(text) - F.length(F.translate(text, _MARK, ""))


def word_list(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _GAP), lambda x: x != "")


def word_hashes(text: Column) -> Column:
    return F.transform(word_list(text), lambda x: F.xxhash64(x))


def shingles(words: str, n: int = WORDS) -> Column:
    """Hashes of all runs of n words, repeats included, from a column of word hashes; a shorter text has none.

    Shifted copies of the list are zipped, so that nothing is looked up by position inside a lambda.
    """
    w = F.col(words)
    size = F.greatest(F.size(w) - (n - 1), F.lit(0))
    runs = F.arrays_zip(*[F.slice(w, i + 1, size).alias(f"w{i}") for i in range(n)])
    return F.transform(runs, lambda z: F.xxhash64(z))


def _kind(segment: Column) -> Column:
    """p for prose, t for technical, b for list-like. What most segments settle is asked first."""
    several = segment.rlike(_TWO_WORDS) & ((F.length(segment) < 2 * SENTENCE_WORDS) | (F.regexp_count(segment, F.lit(_WORD)) <= SENTENCE_WORDS))
    digits = F.length(segment) - F.length(F.translate(segment, "0123456789", ""))
    numbers = (digits > 0.3 * _ink(segment)) & (F.regexp_count(segment, F.lit(_PRODUCT)) * PRODUCT_WORDS < F.regexp_count(segment, F.lit(_WORD)))
    return F.when(segment.rlike(_END) & several, "p").when(segment.rlike(_TECHNICAL) | numbers, "t").otherwise("b")


def _key_share(words: str, part: int) -> Column:
    """Share of the words of a sorted list that are held by words making up at least one in `part` each (and 3)."""
    w = F.col(words)
    n = F.size(w)
    k = F.greatest(F.lit(3), F.ceil(n / part).cast("int"))
    # in a sorted list, a word that stands k times or more equals the one k - 1 on; its first k - 1 places are added
    z = F.arrays_zip(w.alias("x"), F.slice(w, k, F.greatest(n, F.lit(1))).alias("on"), F.concat(F.array(F.lit(None).cast("long")), w).alias("before"))
    runs = F.filter(z, lambda r: r["x"] == r["on"])
    heads = F.filter(runs, lambda r: ~r["x"].eqNullSafe(r["before"]))
    return F.when(n > 0, (F.size(runs) + (k - 1) * F.size(heads)) / n).otherwise(0.0)


def list_evidence(pages: DataFrame, text: str, words: str) -> DataFrame:
    """pages (text without invisible characters, and the hashes of its words) with density, bare_links, bare_words, items, products, bare_keyed, short_words, keyed, words and technical.

    Only built-in expressions; each column that others are made of is a step of its own, so that nothing is computed twice.
    """
    where = lambda has, x, then: F.when(has, then).otherwise(x)
    t = F.col(text)
    d = pages.withColumn("_s", where(t.contains("<"), t, F.regexp_replace(t, _BREAK, "\n")))
    t = F.col("_s")
    d = d.withColumn("_t", where(t.contains("<") | t.contains("["), t, F.regexp_replace(F.regexp_replace(t, _ANCHOR, f" {_MARK} "), _TAG, " ")))
    t = F.col("_t")
    d = d.withColumn("_t", where(t.rlike(_HINT), t, F.regexp_replace(t, _LINK, f" {_MARK} ")))
    t = F.col("_t")
    d = d.withColumn("_t", where(t.contains("]("), t, F.regexp_replace(t, _MARKDOWN, f" $1 {_MARK} ")))
    segments = F.filter(F.split("_t", _SEGMENT), lambda x: F.trim(x) != "")
    d = d.withColumn("_seg", F.transform(segments, lambda x: F.struct(_kind(x).alias("k"), x.alias("x"))))
    join = lambda k: F.array_join(F.transform(F.filter("_seg", lambda z: z["k"] == k), lambda z: z["x"]), "\n")
    d = d.withColumns({"_bare": join("b"), "_tech": join("t"), "_marks": _marks(F.col("_t")), "_ink": _ink(F.col("_t"))}).drop("_seg", "_t")
    d = d.withColumns({"bare_links": _marks(F.col("_bare")), "_ink_b": _ink(F.col("_bare")), "_ink_t": _ink(F.col("_tech")), "_w": word_list(F.translate("_bare", "_", " "))})
    # a mark stands for the link or tag whose characters it took the place of
    d = d.withColumn("_links", F.when(F.col("_marks") > 0, F.greatest(_ink(F.col("_s")) - F.col("_ink") + F.col("_marks"), F.lit(0))).otherwise(0)).drop("_s")
    d = d.withColumns({"_sb": F.sort_array(F.transform("_w", lambda x: F.xxhash64(x))), "_sa": F.sort_array(words)})
    c = F.col
    whole = F.greatest(c("_links") + c("_ink") - c("_marks"), F.lit(1))
    linked = c("_links") * c("bare_links") / F.greatest("_marks", F.lit(1))
    out = {
        "density": (linked + c("_ink_b") - c("bare_links")) / whole,
        "technical": (c("_ink_t") - _marks(c("_tech"))) / whole,
        "bare_words": F.size("_w"),
        "items": F.size(F.filter(F.split("_bare", _ITEM), lambda x: F.trim(x) != "")),
        "products": F.regexp_count("_bare", F.lit(_PRODUCT)),
        "bare_keyed": _key_share("_sb", KEY_PART),
        "short_words": F.size(F.filter("_w", lambda x: F.length(x) <= 3)) / F.greatest(F.size("_w"), F.lit(1)),
        "keyed": _key_share("_sa", DRESSED_PART),
        "words": F.size("_sa"),
    }
    return d.withColumns(out).drop("_bare", "_tech", "_links", "_marks", "_ink_b", "_ink_t", "_ink", "_w", "_sb", "_sa")


EVIDENCE = ["density", "bare_links", "bare_words", "items", "products", "bare_keyed", "short_words", "keyed", "words", "technical"]


def _once_and_again(sorted_shingles: str) -> tuple[Column, Column]:
    """Shingles that a sorted list holds once, and those that it holds several times, each taken once."""
    s = F.col(sorted_shingles)
    runs = F.arrays_zip(s.alias("x"), F.slice(s, 2, F.size(s)).alias("after"), F.concat(F.array(F.lit(None).cast("long")), s).alias("before"))
    first = lambda z: z["x"].isNotNull() & ~z["x"].eqNullSafe(z["before"])
    twice = lambda z: z["x"].eqNullSafe(z["after"])
    return F.transform(F.filter(runs, lambda z: first(z) & ~twice(z)), lambda z: z["x"]), F.transform(F.filter(runs, lambda z: first(z) & twice(z)), lambda z: z["x"])


def host_of(host: str, page: str) -> Column:
    """A page without host is a host of its own."""
    return F.when(F.col(host).isNotNull(), F.xxhash64(F.col(host))).otherwise(F.xxhash64(F.lit("page"), F.col(page)))


def hosts_per_phrase(phrases: DataFrame, phrase: str = "sh") -> DataFrame:
    """(phrase, n_hosts) of rows (phrase, host). Pairs are made distinct first, so that a phrase on a third of all pages is counted
    from partial counts and never meets in one task."""
    return phrases.select(phrase, "host").distinct().groupBy(phrase).agg(F.count(F.lit(1)).alias("n_hosts"))


def verdict() -> Column:
    """Whether the evidence of a page, phrases and list density joined, makes it one of repeated keywords, links or tags."""
    c = F.col
    stitched = F.coalesce(c("stitched") >= STITCHED, F.lit(False))
    enough = lambda name, least: c(name) >= F.when(stitched, -(-least // FEWER)).otherwise(least)
    words, per_item = enough("bare_words", FEW_WORDS), c("bare_words") / F.greatest("items", F.lit(1))
    links = c("bare_links") >= FEW_LINKS
    tags = words & enough("items", FEW_ITEMS) & (per_item <= ITEM_WORDS) & (c("short_words") < SHORT_LISTED)
    products = words & (c("products") * PRODUCT_WORDS >= c("bare_words"))
    keyed = words & (c("bare_keyed") >= KEYED)
    run = (c("bare_words") >= RUN_WORDS) & (c("short_words") < SHORT_WORDS) & (per_item > ITEM_WORDS)
    listed = (c("density") > MOSTLY) & (links | tags | products | keyed | run)
    dressed = (c("words") >= FEW_WORDS) & (c("keyed") >= KEYED) & (c("technical") < TECHNICAL)
    repeated = stitched & (c("repeated") >= REPEATED) & (c("technical") < TECHNICAL)
    return listed | dressed | repeated | ((c("copied") == 1) & (c("phrases") >= COPY_WORDS))


def pages(docs: DataFrame, id_col: str, host_col: str, text_col: str) -> DataFrame:
    """Evidence and verdict of every page: id, the columns of list_evidence, stitched, repeated, copied, phrases, flagged.

    stitched, repeated and copied are null for pages of fewer than five words. Texts are read once and never shuffled: one
    pass takes list density and counted shingles.
    """
    d = docs.select(F.col(id_col).alias("id"), host_of(host_col, id_col).alias("host"), visible(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    e = list_evidence(d.withColumn("w", word_hashes(F.col("text"))), "text", "w").drop("text")
    # separate columns of word hashes and of sorted shingles, so that texts are split once
    e = e.withColumn("s", F.sort_array(shingles("w"))).drop("w")
    once, again = _once_and_again("s")
    e = e.withColumns({"once": once, "again": again, "phrases": F.size("s")}).drop("s")
    e = cut_lineage(e.withColumn("row", F.monotonically_increasing_id()))
    # phrases that a page holds once count if they stand elsewhere; those that it repeats count anyway, but have hosts as well
    each = e.select("host", "row", F.explode(F.concat(F.transform("once", lambda x: F.struct(x.alias("sh"), F.lit(1).alias("new"))), F.transform("again", lambda x: F.struct(x.alias("sh"), F.lit(0).alias("new"))))).alias("p")).select("host", "row", "p.*")
    spread = cut_lineage(hosts_per_phrase(each).filter("n_hosts > 1"))
    elsewhere = each.select("row", "sh", "new").join(sized(spread), "sh").groupBy("row").agg(F.sum("new").alias("n_elsewhere"), F.count_if(F.col("n_hosts") >= MANY_HOSTS).alias("n_many"))
    n, kinds = F.col("phrases"), F.size("once") + F.size("again")
    own = e.select("row", "id", *EVIDENCE, "phrases", F.when(n > 0, 1 - kinds / n).alias("repeated"), (n - F.size("once")).alias("n_again"), kinds.alias("kinds"))
    out = own.join(elsewhere, "row", "left").withColumn("stitched", F.when(n > 0, (F.col("n_again") + F.coalesce("n_elsewhere", F.lit(0))) / n)).withColumn("copied", F.when(n > 0, F.coalesce("n_many", F.lit(0)) / F.col("kinds")))
    return out.withColumn("flagged", F.coalesce(verdict(), F.lit(False))).groupBy("id").agg(*[F.max(c).alias(c) for c in (*EVIDENCE, "stitched", "repeated", "copied", "phrases", "flagged")])
