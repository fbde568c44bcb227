"""Freely typed values mapped to the closest entry of a reference list.

Method: a prefix-filter set-similarity join, used twice. First each distinct typed word is joined
with the words of the reference list (and their known abbreviations and synonyms) as a set of
letters and letter pairs; then each distinct value is joined with the entries as a set of all words
so found, by a bound that every pair of enough agreement keeps. Tokens are ordered by global rarity, only rare prefixes are joined, length and positional
filters are applied and the overlap is verified exactly; the best entry is kept. An exact check of the
edit distance of each word follows the first join, a count by position the second.

Values without an entry of enough similarity get ref_id 0. Null and blank values have no row; a
value that is letter for letter an entry is left to the caller. Equal scores go to the entry whose
words are nearer, then to the smaller ref_id. Work grows with the distinct words and values, not
with the rows; an empty table or an empty list gives no rows or only zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worktally.llm.setjoin import similarity_join
from worktally.runtime import cut

#: Least Jaccard similarity of a typed word and a known word.
WORD_SIMILARITY = 0.4
#: Alternatives of a word are kept if they are at most so much less near than its best one, or its singular or plural.
ALTERNATIVES_WITHIN = 0.2
#: Least share of an entry's and a value's words, counted by position, that must agree.
AGREEMENT = 0.5

#: Words that carry no meaning in a value.
FILLERS = (
    "of and the for in at to a an with by n etc new no nos number phase ph part work works sector category proposed balance "
    "remaining near ward vill village ii iii iv down as per existing various scheme schemes programme up g&"
).split()

#: Abbreviations and synonyms of words in public-works lists, and what they stand for.
SYNONYMS = {
    "construction": "const constn constr constrn construct constructing cons co",
    "installation": "inst instln install instl installing",
    "provision": "prov provn providing provide",
    "supply": "sup supplying supp sply",
    "renovation": "renov renovating reno renovn",
    "repair": "rep repairing repairs rpr",
    "development": "dev devt devl developing devp",
    "extension": "extn extending ext",
    "erection": "erec erecting erectn",
    "distribution": "distr distributing distrn dist distbn",
    "laying": "lyg lay layg",
    "purchase": "purch procurement purchasing",
    "replacement": "repl replacing replcmt",
    "excavation": "exc excav excavating digging",
    "plantation": "plantn planting plntn",
    "beautification": "beautifn beautifying beautn",
    "restoration": "restn restoring restor",
    "widening": "wdg widen wideng",
    "drilling": "drlg drill",
    "desilting": "desilt dslt",
    "lining": "lng",
    "road": "rd sadak marg",
    "street": "st gali",
    "drain": "nali naali",
    "hostel": "chhatravas chatravas",
    "godown": "warehouse gowdown",
    "water": "wtr pani jal",
    "cement": "cem cmt",
    "concrete": "conc concr",
    "electric": "elec elect electrical",
    "irrigation": "irrig irrign irrgn irr",
    "equipment": "eqpt equip eqp",
    "panchayat": "panch gp pt",
    "building": "bldg",
    "buildings": "bldgs bldg",
    "community": "comm cmnty commty samudayik",
    "drainage": "drng drg",
    "sanitation": "sanit sanitn",
    "public": "pub pblc",
    "transport": "transp tpt trnsp tpts trans",
    "control": "ctrl cntrl",
    "agriculture": "agric agri krishi",
    "livestock": "lstk pashu",
    "disability": "disab divyang",
    "environment": "env environ envt paryavaran",
    "education": "educ edn edu shiksha",
    "health": "swasthya hlth",
    "power": "electricity bijli vidyut pwr",
    "lighting": "lights light ltg",
    "library": "lib pustakalay",
    "digital": "dig dgtl",
    "laboratory": "lab",
    "additional": "addl addnl",
    "centre": "center ctr kendra",
    "primary": "pry prim",
    "motorised": "motorized",
    "classroom": "class-room",
    "school": "sch vidyalay",
    "hospital": "hosp",
    "transformer": "trf tfr transf",
    "station": "stn",
    "bridge": "pul",
    "bridges": "brdgs",
    "gymnasium": "gym",
    "playground": "maidan ground",
    "toilet": "shauchalay sauchalaya shauchalaya sauchalay",
    "vehicle": "veh",
    "machine": "mach",
    "village": "gram",
    "household": "hh",
    "hall": "bhawan bhavan",
    "culvert": "pulia puliya",
    "well": "kuan kuaan",
    "pond": "talab taalab",
    "garden": "udyan bagicha",
    "shelter": "stop stand",
    "borewell": "bore nalkoop",
    "overhead": "head oh ovhd",
    "boundary": "bdry bdary",
    "temple": "mandir",
    "tree": "ped",
    "nallah": "nala nullah",
    "canal": "nahar",
    "market": "bazar haat",
}
#: Single words that stand for several.
COMPOUNDS = {"handpump": "hand pump", "peyjal": "drinking water", "khelkood": "sports", "khel": "sports", "kood": "sports", "streetlight": "street light", "xray": "x ray", "wheelchairs": "wheel chairs", "wheelchair": "wheel chairs", "chahardiwari": "boundary wall", "chardiwari": "boundary wall"}


def clean(x: Column) -> Column:
    """A value in lower case without scheme numbers, list marks, places and dots of acronyms."""
    s = F.lower(F.regexp_replace(x, r"[\s\p{Z}_]+", " "))
    s = F.regexp_replace(s, r"^\s*ws/\s*\p{L}+\d*/\d{4}(-\d{2,4})?/\d+\s*-\s*", "")
    s = F.regexp_replace(s, r"^[\s*\-]*(\(?[a-z0-9]{1,2}\)|\d{1,2}\.)\s*", "")
    s = F.regexp_replace(s, r",?\s+(at|near|in\s+ward|in\s+village|vill(age)?\.?)\s+\p{L}+[\p{P}\s]*$", "")
    s = F.regexp_replace(s, r"\bc/o\b", " const ")
    s = F.regexp_replace(s, r"\bb/d?ary\b", "boundary")
    s = F.regexp_replace(s, r"(?<=\b\p{L})\.(?=\p{L}\b)", "")
    s = F.regexp_replace(s, "khel-kood", "khelkood")
    return F.trim(F.regexp_replace(s, r"[^\p{L}\p{M}]+", " "))


def _pieces(word: Column) -> Column:
    """Letters and, with marks at both ends, letter pairs of a word; repeated ones are numbered."""
    padded = F.concat(F.lit("^"), word, F.lit("$"))
    pairs = F.transform(F.sequence(F.lit(1), F.length(word) + 1), lambda i: padded.substr(i, F.lit(2)))
    both = F.concat(F.split(word, ""), pairs)
    numbered = F.transform(both, lambda p, i: F.concat(p, F.size(F.filter(F.slice(both, 1, i + 1), lambda q: q == p)).cast("string")))
    return F.array_distinct(numbered)


def _entries(reference: DataFrame) -> DataFrame:
    words = F.array_distinct(F.filter(F.split(clean(F.col("name")), " "), lambda w: ~w.isin(*FILLERS) & (w != "")))
    return reference.select("kind", F.col("ref_id").cast("bigint").alias("ref_id"), words.alias("words")).filter(F.size("words") > 0)


def _known_words(entries: DataFrame) -> DataFrame:
    """(kind, form, stands_for): the words of the entries and the forms that stand for them; fillers stand for nothing."""
    spark = entries.sparkSession
    words = entries.select("kind", F.explode("words").alias("w")).distinct()
    aliases = [(a, w) for w, forms in SYNONYMS.items() for a in forms.split()]
    alias_rows = spark.createDataFrame(aliases, "form string, w string")
    compound_rows = spark.createDataFrame([(c, m.split()) for c, m in COMPOUNDS.items()], "form string, stands_for array<string>")
    kinds = entries.select("kind").distinct()
    own = words.select("kind", F.col("w").alias("form"), F.array("w").alias("stands_for"))
    other = words.join(alias_rows, "w").select("kind", "form", F.array("w").alias("stands_for"))
    # A compound counts for a kind if all its words occur there.
    parts = compound_rows.select("form", "stands_for", F.explode("stands_for").alias("w")).join(words, "w")
    compound = parts.groupBy("kind", "form", "stands_for").agg(F.countDistinct("w").alias("n")).filter(F.col("n") == F.size("stands_for")).select("kind", "form", "stands_for")
    filler = kinds.withColumn("form", F.explode(F.array(*[F.lit(f) for f in FILLERS if len(f) > 2]))).select("kind", "form", F.array().cast("array<string>").alias("stands_for"))
    return own.unionByName(other).unionByName(compound).unionByName(filler.join(own.select("kind", "form"), ["kind", "form"], "left_anti")).distinct()


def match_words(words: DataFrame, known: DataFrame) -> DataFrame:
    """(kind, word, alternatives): the known words each typed word may mean, as structs (stands_for, near)."""
    # The length filter, before any pieces are made: a word of n letters has 2n + 1 of them.
    longest_known = known.agg(F.max(F.length("form"))).first()[0] or 0
    words = words.filter(F.length("word") <= int((2 * longest_known + 1) / WORD_SIMILARITY / 2))
    left = words.select(F.concat_ws("|", "kind", "word").alias("id"), _tagged(F.col("kind"), F.col("word")).alias("tokens"))
    right = known.select("kind", "form").distinct().select(F.concat_ws("|", "kind", "form").alias("id"), _tagged(F.col("kind"), F.col("form")).alias("tokens"))
    split = lambda c, i: F.split(F.col(c), r"\|")[i]
    joined = similarity_join(left, right, WORD_SIMILARITY).select(
        split("left_id", 0).alias("kind"), split("left_id", 1).alias("word"), split("right_id", 1).alias("form"), "jaccard"
    )
    sorted_letters = lambda c: F.array_join(F.sort_array(F.split(F.col(c), "")), "")
    swapped = sorted_letters("word") == sorted_letters("form")
    distance = F.when(swapped, F.least(F.levenshtein("word", "form"), F.lit(1))).otherwise(F.levenshtein("word", "form"))
    longest = F.greatest(F.length("word"), F.length("form"))
    near = 1 - distance / longest
    allowed = F.when(longest <= 4, 1).when(longest == 5, 2).when(longest <= 7, 3).otherwise(F.floor(longest * 0.4))
    plausible = (distance <= allowed) & ((F.length("word") > 2) | (distance == 0))
    plural = (F.col("form") == F.concat("word", F.lit("s"))) | (F.col("word") == F.concat("form", F.lit("s")))
    best = Window.partitionBy("kind", "word")
    return (
        joined.withColumns({"distance": distance, "near": near + F.col("jaccard") / 1000})
        .filter(plausible)
        .withColumn("top", F.max("near").over(best))
        .filter((F.col("near") >= F.col("top") - ALTERNATIVES_WITHIN) | plural)
        .join(known, ["kind", "form"])
        .groupBy("kind", "word", "stands_for")
        .agg(F.max("near").alias("near"))
        .groupBy("kind", "word")
        .agg(F.collect_list(F.struct("stands_for", "near")).alias("alternatives"))
    )


def _tagged(kind: Column, word: Column) -> Column:
    return F.transform(_pieces(word), lambda p: F.concat(kind, F.lit(":"), p))


def map_values(values: DataFrame, reference: DataFrame) -> DataFrame:
    """(kind, value, ref_id, score): the entry each distinct value means, or ref_id 0 and score null.

    ``values`` has kind and value, ``reference`` kind, ref_id and name.
    """
    distinct = values.filter("value IS NOT NULL").select("kind", "value").distinct()
    cleaned = cut(distinct.withColumn("core", clean(F.col("value"))))
    entries = cut(_entries(reference))
    cores = cleaned.select("kind", "core").distinct().filter("core <> ''")
    placed = cut(cores.select("kind", "core", F.posexplode(F.split("core", " ")).alias("at", "word")).filter("word <> ''"))
    known = cut(_known_words(entries))
    words = placed.select("kind", "word").distinct()
    found = cut(match_words(words, known))
    # Every word by position: what it may stand for; unknown words stand for themselves, fillers for nothing.
    read = placed.join(found, ["kind", "word"], "left")
    nearest = F.array_max(F.transform("alternatives", lambda a: F.struct(a["near"].alias("near"), F.size(a["stands_for"]).alias("n"))))
    is_filler = F.col("alternatives").isNotNull() & (nearest["n"] == 0)
    read = read.filter(~(is_filler | (F.col("alternatives").isNull() & (F.col("word").isin(*FILLERS) | (F.length("word") < 4)))))
    options = F.when(F.col("alternatives").isNull(), F.array(F.struct(F.array(F.concat(F.lit("?"), "word")).alias("stands_for"), F.lit(0.0).alias("near")))).otherwise(F.filter("alternatives", lambda a: F.size(a["stands_for"]) > 0))
    read = cut(read.select("kind", "core", "at", options.alias("options")))
    units = F.expr("aggregate(positions, 0, (n, p) -> n + greatest(1, array_max(transform(p.options, o -> size(o.stands_for)))))")
    sets = (
        read.groupBy("kind", "core")
        .agg(F.collect_list(F.struct("at", "options")).alias("positions"), F.array_distinct(F.flatten(F.flatten(F.collect_list(F.col("options.stands_for"))))).alias("words"))
        .select("kind", "core", "positions", "words", units.alias("n_words"))
    )
    sets = cut(sets)
    tag = lambda ws: F.transform(ws, lambda w: F.concat(F.col("kind"), F.lit(":"), w))
    left = sets.select(F.concat_ws("|", "kind", "core").alias("id"), tag(F.col("words")).alias("tokens"), "n_words")
    right = entries.select(F.col("ref_id").cast("string").alias("id"), tag(F.col("words")).alias("tokens"))
    # No position counts more than its units, so a pair left out here is below AGREEMENT in the check that follows.
    pairs = similarity_join(left, right, AGREEMENT, "n_words").select(
        F.split("left_id", r"\|")[0].alias("kind"), F.split("left_id", r"\|")[1].alias("core"), F.col("right_id").cast("bigint").alias("ref_id"), "jaccard"
    )
    # Exact check by position: each position counts once, with the nearest alternative that is in the entry.
    hits = F.expr(
        "transform(positions, p -> array_max(transform(p.options, o -> "
        "CASE WHEN size(array_intersect(o.stands_for, entry)) > 0 THEN struct(o.near AS near, size(array_intersect(o.stands_for, entry)) AS n, array_intersect(o.stands_for, entry) AS ws) END)))"
    )
    judged = (
        pairs.join(sets, ["kind", "core"])
        .join(entries.withColumnRenamed("words", "entry"), ["kind", "ref_id"])
        .withColumn("hits", F.array_compact(hits))
        .withColumn("covered", F.size(F.array_distinct(F.flatten(F.col("hits.ws")))))
        .withColumn("near", F.expr("aggregate(hits, 0D, (s, h) -> s + h.near * h.n)"))
        .withColumn("score", F.col("covered") / (F.col("n_words") + F.size("entry") - F.col("covered")))
        .filter(F.col("score") >= AGREEMENT)
    )
    best = judged.groupBy("kind", "core").agg(F.max(F.struct("score", "near", "jaccard", (-F.col("ref_id")).alias("r"))).alias("b"))
    by_core = best.select("kind", "core", (-F.col("b.r")).alias("ref_id"), F.col("b.score").alias("score"))
    return cleaned.join(by_core, ["kind", "core"], "left").select("kind", "value", F.coalesce("ref_id", F.lit(0)).cast("bigint").alias("ref_id"), "score")
