"""Licence scan by canonical digests. Built-in expressions only.

A text is brought to a canonical form: lines dropped that name a copyright holder
and say nothing else; lower case; everything but letters, digits and bytes beyond ASCII read as blank; runs of
blanks made one; equivalent spellings made one. The SHA-256 digest of the whole
canonical text is hash-joined with the digests of the known licences, so equal
licences meet whatever their layout. Every line is looked up the same way, for
documents that merely carry a notice.

Defined results: null text is the empty text, whose digest is in the result
and matches nothing; repeated rows are scanned one by one; an empty table gives
an empty result; further columns are ignored. The list of known licences is
small and bounded by its caller: its digests are a literal of the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm.license_texts import LICENSES



# Lines that state a copyright, and spellings that are one. Such a line
# begins with a sign or word for copyright and goes on with years and a holder. It says
# more, and stays, if it has a semicolon or a word of SAYS (a name may begin with one of
# NAMES). Without a year it also stays if its first word beside JOINS is one of BODY, as
# in wrapped texts, lists and prose, or if a word is neither written as a name nor one of
# JOINS and HOLDERS, or all are JOINS.
_GAP = r"[^a-z0-9(&\x{80}-\x{10FFFF}]"
MARK = (
    rf"(?i)^[^a-z0-9©(]*(?:(?:portions|parts|modifications|additions|changes|contributions){_GAP}+(?:are{_GAP}+)?)?"
    rf"(?:copyright\b{_GAP}*(?:\(c\)|©|&copy;)?|\(c\){_GAP}*(?:copyright\b)?|©|spdx-filecopyrighttext:){_GAP}*(?:by{_GAP}+)?"
)
RESERVED = r"(?i)^[^a-z0-9]*all rights reserved[^a-z0-9]*$"
ASIDE = r"(?i)all rights reserved|\S*@\S*|\S+://\S*"
YEAR_FIRST = r"(?i)^[^a-z0-9]*(?:[0-9]{4}|year|yyyy)"
YEAR = r"^(?:[0-9]{4}|[0-9]{2}|year|yyyy|present)$"
BETWEEN = r"[^0-9A-Za-z\x{80}-\x{10FFFF}]+"
SAYS = (
    "am are be been can cannot did do does except forbidden granted had has have if is its may must need needs no not permitted prohibited required shall "
    "should than that their them these they this those under unless until was were when where which who will with without you your"
).split()
NAMES = ["may", "will"]
JOINS = "a al all an and by da de del der di et for from in la le of on or the to van von".split()
HOLDERS = "author authors co company contributor contributors developers gmbh inc llc ltd original others project team".split()
BODY = (
    "above act acts also any as assignment before but c claim claims clearance clearances copyright disclaimer disclaimers doctrine doctrines each exception "
    "exceptions file following grant held holder holders infringement infringements interest interests it law laws legislation library license licensed licensee "
    "licenses licensing licensor like line lines material materials notice notices office only owned owner owners ownership patent patents permission permissions "
    "policy program protected protection protections registration registrations related representations resulting right rights same software statement statements "
    "status such term terms then there treaties treaty we while work works"
).split()
PUNCTUATION = r"[\x00-\x1F !-/:-@\[-`{-\x7F]+"
SPELLINGS = [
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sublicence", "sublicense"),
    ("owner", "holder"),
    ("owners", "holders"),
    ("https", "http"),
    ("noncommercial", "non commercial"),
    ("merchantibility", "merchantability"),
    ("favour", "favor"),
    ("programme", "program"),
]


def canonical(text: Column) -> Column:
    return _respelt(_plain(lowered(text)))


def lowered(text: Column) -> Column:
    """The text in lower case, lines that state a copyright left empty."""
    return F.lower(F.array_join(F.transform(F.split(text, "\n"), lambda x: F.when(states_copyright(x), F.lit("")).otherwise(x)), "\n"))


def states_copyright(line: Column) -> Column:
    return F.when(line.rlike(RESERVED), F.lit(True)).when(line.rlike(MARK), _holder(F.regexp_replace(line, MARK, ""))).otherwise(F.lit(False))


def _holder(rest: Column) -> Column:
    """Whether what follows the mark is years and a holder and nothing else."""
    named = F.regexp_replace(rest, ASIDE, " ")
    stated = F.filter(F.split(named, BETWEEN), lambda w: (w != "") & ~F.lower(w).rlike(YEAR))
    dated = named.rlike(YEAR_FIRST)
    of = lambda words: F.array(*map(F.lit, words))

    def judged(words: Column) -> Column:
        low = F.transform(words, lambda w: F.lower(w))
        name_first = (F.size(low) <= 3) & F.coalesce(F.array_contains(of(NAMES), F.get(low, F.lit(0))), F.lit(False))
        says = F.when(name_first, F.slice(low, 2, 3)).otherwise(low)
        held = F.filter(low, lambda w: ~F.array_contains(of(JOINS), w))
        written = F.forall(words, lambda w: ~w.rlike("^[a-z]") | F.array_contains(of(JOINS + HOLDERS), F.lower(w)))
        bare = (F.size(held) > 0) & written & ~F.coalesce(F.array_contains(of(BODY), F.get(held, F.lit(0))), F.lit(False))
        return ~F.contains(named, F.lit(";")) & ~F.arrays_overlap(says, of(SAYS)) & (dated | bare)

    return F.transform(F.array(stated), judged)[0]


def _plain(lowered: Column) -> Column:
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, PUNCTUATION, " ")), F.lit(" "))


def _respelt(plain: Column) -> Column:
    for other, one in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {other} "), F.lit(f" {one} "))
    return F.trim(plain)


def digest(canon: Column) -> Column:
    return F.sha2(canon, 256)


def known_digests(spark: SparkSession, known: list[tuple[str, str]]) -> DataFrame:
    """``license, digest`` of the known texts, each digest once."""
    rows = spark.createDataFrame(known, "license string, text string")
    return rows.groupBy(digest(canonical(F.col("text"))).alias("digest")).agg(F.min("license").alias("license"))


def scan(docs: DataFrame, known: list[tuple[str, str]] = LICENSES) -> DataFrame:
    """``doc_id``, ``digest`` of the whole text, its ``license`` (null if it is
    none), ``n_license_lines`` and the distinct ``line_licenses``, joined by a
    comma."""
    digests = known_digests(docs.sparkSession, known)
    of = {r["digest"]: r["license"] for r in digests.collect()}  # one row per known text at most
    lookup = F.create_map(*[F.lit(v) for pair in sorted(of.items()) for v in pair]) if of else F.create_map().cast("map<string,string>")
    low = lowered(F.coalesce(F.col("text").cast("string"), F.lit("")))
    lines = F.split("lowered", "\n")
    found = F.filter(F.transform(lines, lambda x: lookup[digest(_respelt(_plain(x)))]), lambda x: x.isNotNull())
    marked = docs.select("doc_id", low.alias("lowered")).select("doc_id", digest(_respelt(_plain(F.col("lowered")))).alias("digest"), found.alias("found"))
    whole = digests.select(F.col("digest").alias("known"), "license")
    return marked.join(whole, F.col("digest") == F.col("known"), "left").select(
        "doc_id",
        "digest",
        "license",
        F.size("found").cast("long").alias("n_license_lines"),
        F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("line_licenses"),
    )

