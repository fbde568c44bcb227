"""Variant spellings of names, linked by canonical rewritings.

Method: each distinct spelling is rewritten by rules for titles, terms, token order, joined tokens,
initials, nicknames, legal forms, sounds spelt alike and one mistyped letter; the forms are exploded
and equi-joined within a state. What a form proves depends on the rule:

* a full canonical form (all tokens in any order, or all of them joined) links its bearers;
* a form with one letter left out (``_slips``) links two persons only if it is rare and says enough:
  the score counts the letters that agree, less what a slip at this place and of this kind costs,
  less the bearers of the form, more for a shared constituency (``SLIP_SCORE``);
* a short form (an initial, a nickname, a middle name left out) links only where all bearers of the
  full form are one person, in the constituency or else in the state, and only if its letters say
  enough (``SHORT_SCORE``). A prefix is such a form, never a key of its own.

Forms of one spelling are made once: records are grouped to spellings, spellings to persons by full
forms, and only then are letters left out, for tokens that another person shares. Links are transitive.
A full form links its bearers to the least of them, not to each other; a slip's bearers are held against one
of each name and writing (``_near_slips``). Copies cost nothing.

Defined cases: null and blank names, and names without letters, are left out; without a state a
name is linked only if its full form occurs in one state alone; one key with several rows is one
record. Empty tables give no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worktally.llm.components import connected_components
from worktally.runtime import cut, shuffle_width

#: Titles before and after a name.
TITLES = frozenset(
    "shri shree sri shrimati smt dr mr mrs ms miss prof professor late adv advocate er engr capt col major maj gen lt sh km kum kumari "
    "hon honble ble sushri pandit pt thiru tmt com comrade justice sardar mohd md".split()
)
AFTER = frozenset("ji sahab saheb garu jr sr mp mla".split())
#: Endings of nicknames.
NICK_ENDINGS = ("ji", "oo", "u", "i", "y", "ie")
#: Given names and the short names used for them.
NICKNAMES = {
    "abhishek": "abhi", "aditya": "adi", "alexander": "alex sandy", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny",
    "catherine": "kate cathy", "charles": "charlie chuck", "christopher": "chris kit", "daniel": "dan danny", "david": "dave", "edward": "ed ted eddie",
    "elizabeth": "liz beth betty", "francis": "frank", "harold": "harry", "henry": "harry hank", "james": "jim jimmy", "jaswinder": "jassi", "john": "jack johnny",
    "joseph": "joe", "krishna": "kishan", "lakshmi": "laxmi", "lakshman": "laxman", "lawrence": "larry", "margaret": "maggie peggy", "mary": "molly", "michael": "mike mick",
    "mohammad": "mohd md mohammed muhammad", "nicholas": "nick", "patricia": "pat patty", "patrick": "pat paddy", "peter": "pete", "richard": "dick rick", "robert": "bob rob bobby",
    "samuel": "sam", "stephen": "steve", "susan": "sue", "theodore": "ted", "thomas": "tom tommy", "vikram": "vicky", "william": "bill will billy", "zachary": "zack",
}
#: Legal forms of organisations and their abbreviations.
LEGAL_FORMS = {
    "limited": "ltd", "private": "pvt", "company": "co", "corporation": "corp", "incorporated": "inc", "association": "assn assoc", "brothers": "bros",
    "enterprises": "entp enterprise", "industries": "inds industry", "government": "govt", "department": "dept", "society": "soc", "cooperative": "coop",
}
#: Given names so common that none of them is taken for a mistyped other.
COMMON_NAMES = (
    "abhay ajay ajit akash akhil akshay alok aman amar amit amrit anand anil anita anjali anju ankit anshu anup anuj arjun arun asha ashok ashish atul babita balram bharat bhavna bhupendra bimal "
    "chandan chetan daya deepa deepak deepika devendra devika dharmendra dinesh durga ganesh gaurav geeta girish gita gopal govind harish hari hemant hemlata hitendra indira jagdish jaya jitendra jyoti "
    "kailash kamal kamala kamla karan kavita kedar kiran kishan kishor krishan lalit lalita lata lokesh madan madhav madhu mahendra mahesh mamta manish manisha manju manoj meena meera mithun mohan mohit mukesh "
    "nagendra naresh narendra narayan naveen navin neeraj neha nilesh nitesh nitin om parvati paras pankaj poonam pooja prabha pradeep prakash pramod pratap pratik praveen prem priya pushpa radha raghav rahul "
    "raj raja rajat rajeev rajendra rajesh rajeshwar rajni rajiv rakesh ram rama ramesh rameshwar rana ranjan ranjit ravi ravindra rekha renu rita ritesh rohan rohit roshan rupesh sachin sanjay sanjeev santosh "
    "sarita satish satyendra savita seema shanti sharad shashi shiv shyam sita sohan sonal sonia subhash sudhir sujata suman sumit sunil sunita suraj surendra suresh sushil sushma tarun uma umesh usha "
    "vandana varun vijay vijendra vikas vimal vinay vineet vinod virendra vishal vivek yash yogendra yogesh"
)
#: A slip links two persons from this score on, and a short form its bearer.
SLIP_SCORE, SHORT_SCORE = 9, 6
#: What a shared constituency adds to a score; what is taken off for another letter in place of one, a slip in the first letter,
#: a vowel more at the end (a woman's name beside a man's), another middle name, tokens that both occur with further names.
SAME_PLACE, OTHER_LETTER, FIRST_LETTER, END_VOWEL, OTHER_MIDDLE, BOTH_KNOWN = 4, 2, 4, 8, 4, 6
#: A token that agrees counts for at most so many letters: family names are shared by many.
KEPT_LETTERS = 5

_BRACKETS = re.compile(r"\([^)]*\)?|\[[^\]]*\]?|\d[\d\-–/]*")
_QUOTED = re.compile(r"[\"“”«»]([^\"“”«»]*)[\"“”«»]")
_JOIN = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HON = re.compile(r"\bhon['’.]?\s?ble\b\.?", re.I)
_LETTERS = re.compile(r"[^\W\d_]+")
_SOUNDS = [(re.compile(a), b) for a, b in (("ch", "C"), ("c", "k"), ("q", "k"), ("x", "ks"), ("w", "v"), ("(?<=[bdgjkpstC])h", ""), ("ee|ii", "i"), ("oo|uu", "u"), ("au", "o"), (r"(.)\1+", r"\1"))]
_TWICE = re.compile(r"(.)\1+")
_LEGAL = {short: full for full, shorts in LEGAL_FORMS.items() for short in shorts.split()}


def parse_name(name: str) -> tuple[list[str], bool]:
    """The lower-case tokens of a name, given name first where the spelling tells, and whether it tells (a comma)."""
    s = name if name.isascii() else "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    s = _HON.sub(" ", _QUOTED.sub(" ", _BRACKETS.sub(" ", s)))
    s = _JOIN.sub(" ", s)
    family, comma, given = s.partition(",")
    parts = [[t.lower() for t in _LETTERS.findall(p)] for p in (family, given)]
    for p in parts:
        while len(p) > 1 and p[0] in TITLES:
            p.pop(0)
        while len(p) > 1 and p[-1] in AFTER:
            p.pop()
    if comma and parts[0] and parts[1]:
        return parts[1] + parts[0], True
    return parts[0] + parts[1], False


_HEARD: dict[str, str] = {}


def sound(token: str) -> str:
    """A token with sounds spelt alike: doubled letters, aa, ee, oo, au, ph, w, c; legal forms in full."""
    heard = _HEARD.get(token)
    if heard is None:
        heard = _LEGAL.get(token, token)
        for pattern, to in _SOUNDS:
            heard = pattern.sub(to, heard)
        if len(_HEARD) > 100_000:
            _HEARD.clear()
        _HEARD[token] = heard
    return heard


_SHORT_FOR = {sound(short): {sound(full) for full in NICKNAMES if short in NICKNAMES[full].split()} for shorts in NICKNAMES.values() for short in shorts.split()}
_SHORTENED = {sound(full): {sound(s) for s in shorts.split()} for full, shorts in NICKNAMES.items()}


def spelt(name: str) -> tuple[list[str], bool]:
    """The tokens of a name: initials as they are, others by sound."""
    tokens, told = parse_name(name)
    return [t if len(t) == 1 else sound(t) for t in tokens], told


def full_forms(tokens: list[str], raw: list[str]) -> list[str]:
    """The forms that give a whole name: all tokens in any order, and all joined with the first or last token turned round.

    A doubled vowel can be a sound of its own (ee for i) or a letter typed twice, so both readings are given.
    """
    once = [sound(_TWICE.sub(r"\1", r)) if len(r) > 1 else r for r in raw]
    out = ["all " + " ".join(sorted(t)) for t in (tokens, once)]
    if all(len(t) > 1 for t in tokens):
        out += ["join " + "".join(o) for t in (tokens, once) for o in (t, t[1:] + t[:1], t[-1:] + t[:-1])]
    return list(dict.fromkeys(out))


def letters_alike(token: str) -> set[str]:
    """A token with single letters of one sound made alike (c, k, q; v, w), and the same with letters typed twice taken once."""
    alike = token.replace("ch", "C").replace("c", "k").replace("q", "k").replace("w", "v")
    return {alike, _TWICE.sub(r"\1", alike)}


def readings(tokens: list[str], told: bool) -> list[tuple[int, int, list[int]]]:
    """The places of given name, family name and middle names under each order the spelling allows."""
    n = len(tokens)
    if n < 2:
        return []
    out = [(0, n - 1, list(range(1, n - 1)))]
    return out if told else [*out, (1, 0, list(range(2, n)))]


def short_forms(tokens: list[str], raw: list[str], told: bool) -> list[tuple[str, str, int]]:
    """(role, form, letters): forms that say less than the name. Role ``w``: a full name could be shortened to it; ``b``: this name is so short.

    ``letters`` says how much a short name tells; a nickname tells less the longer or shorter it is than four letters.
    """
    out: dict[tuple[str, str], int] = {}

    def put(role: str, form: str, letters: int) -> None:
        out[role, form] = max(letters, out.get((role, form), letters))

    for g, f, middle in readings(tokens, told):
        given, family = tokens[g], tokens[f]
        if len(family) == 1:
            continue
        base = min(len(family), KEPT_LETTERS)
        m = tokens[middle[0]] if middle else ""
        if len(given) > 1:
            put("w", f"I {given[0].lower()} {family}", 0)
            if m:
                put("w", f"I {given[0].lower()}{m[0].lower()} {family}", 0)
                put("w", f"P {given} {family}", 0)
            if len(m) > 1:
                put("w", f"G {given} {m[0].lower()} {family}", 0)
                put("w", f"M {given[0].lower()} {m} {family}", 0)
            own = {raw[g]: given} | {raw[g][: -len(e)]: sound(raw[g][: -len(e)]) for e in NICK_ENDINGS if raw[g].endswith(e)}
            # A nickname with its ending is no full name of the nickname without.
            for stem in {sound(raw[g][:k]) for k in range(2, len(raw[g]))} - set(own.values()) | _SHORTENED.get(given, set()):
                put("w", f"N {stem} {family}", 0)
            if not m:
                put("b", f"P {given} {family}", base + min(len(given), KEPT_LETTERS))
            elif len(m) == 1:
                put("b", f"G {given} {m} {family}", base + min(len(given), KEPT_LETTERS))
            for stem, heard in own.items():
                if len(stem) > 1:
                    put("b", f"N {heard} {family}", base + 4 - 2 * abs(len(stem) - 4))
            if given in _SHORT_FOR:
                put("b", f"N {given} {family}", base + 4)
        elif len(m) > 1:
            put("b", f"M {given} {m} {family}", base + 1 + min(len(m), KEPT_LETTERS))
        elif m:
            put("b", f"I {given}{m} {family}", base + 2)
        else:
            put("b", f"I {given} {family}", base + 1)
    return [(role, form, letters) for (role, form), letters in sorted(out.items())]


def _read(rows: DataFrame) -> DataFrame:
    """``rows`` (state, place, name) with the tokens by sound, the raw tokens and whether their order is told."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            seen = {name: (parse_name(name)) for name in pdf["name"].unique()}
            raws = [seen[n][0] for n in pdf["name"]]
            pdf["tokens"] = [" ".join(t if len(t) == 1 else sound(t) for t in r) for r in raws]
            pdf["raw"] = [" ".join(r) for r in raws]
            pdf["told"] = [seen[n][1] for n in pdf["name"]]
            yield pdf

    # Few bytes but much work a row: adaptive execution must not put the rows into few tasks.
    spread = rows.repartition(shuffle_width(rows.sparkSession), "name")
    return spread.mapInPandas(run, "state string, place string, name string, tokens string, raw string, told boolean").filter("tokens <> ''")


def _exploded(units: DataFrame, columns: list[str], make, schema: str) -> DataFrame:
    """The rows that ``make(tokens, raw, told)`` gives for each unit, beside its ``columns``."""
    keep = ", ".join(f"{c} {units.schema[c].dataType.simpleString()}" for c in columns)
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at: list[int] = []
            out: list[tuple] = []
            for i, (tokens, raw, told) in enumerate(zip(pdf["tokens"], pdf["raw"], pdf["told"])):
                made = make(tokens.split(" "), raw.split(" "), told)
                out += made
                at += [i] * len(made)
            base = pdf[columns].take(at).reset_index(drop=True)
            yield pd.concat([base, pd.DataFrame(out, columns=names)], axis=1)

    return units.select(*columns, *[c for c in ("tokens", "raw", "told") if c not in columns]).mapInPandas(run, f"{keep}, {schema}")


def _stars(forms: DataFrame, key: str, node: str) -> DataFrame:
    """(a, b): each bearer of a form with the least bearer; a pair may come more than once."""
    hubs = forms.groupBy(key).agg(F.min(node).alias("a"), F.max(node).alias("z")).filter("a < z").select(key, "a")
    return forms.join(hubs.hint("merge"), key).select("a", F.col(node).alias("b")).filter("a <> b")


def _labelled(rows: DataFrame, node: str, edges: DataFrame) -> DataFrame:
    """``rows`` with each ``node`` replaced by its component's label."""
    labels = connected_components(edges).select(F.col("node").alias(node), "label")
    return rows.join(labels.hint("merge"), node, "left").withColumn(node, F.coalesce("label", node)).drop("label")


def place_key(x: Column) -> Column:
    """A constituency or state in upper case without brackets, marks and blanks."""
    bare = F.regexp_replace(F.upper(x), r"\([^)]*\)|[^\p{L}]+", "")
    return F.when(bare != "", bare)


def has_initials() -> Column:
    """Whether a token is a single letter."""
    return F.col("tokens").rlike(r"(^| )\S( |$)")


def slip_edges(units: DataFrame, places: DataFrame) -> DataFrame:
    """(a, b): spellings of which one is, by the score, a mistyped form of the other.

    ``units`` has unit, canon (one for the orders of the same tokens), state, tokens, raw, told and
    n_keys; ``places`` has unit and place.
    """

    def pairs(tokens: list[str], raw: list[str], told: bool) -> list[tuple]:
        # The token that agrees is taken by sound, the mistyped one as it is spelt.
        if len(tokens) == 1:
            return sorted({("", c, "") for c in letters_alike(raw[0])})
        whole = [(g, f, tokens[m[0]][0] if m else "") for g, f, m in readings(tokens, told) if len(tokens[g]) > 1 and len(tokens[f]) > 1]
        return sorted({(tokens[k], x, m) for g, f, m in whole for k, c in ((g, f), (f, g)) for x in letters_alike(raw[c])})

    split = cut(_exploded(units.filter("state IS NOT NULL"), ["unit", "canon", "state", "n_keys"], pairs, "kept string, changed string, middle string"))
    # Letters are left out only of tokens beside which another name has the same other token.
    block = ["state", "kept"]
    shared = split.groupBy(*block).agg(F.min("canon").alias("a"), F.max("canon").alias("z")).filter("a < z").select(*block)
    alike = F.translate(F.replace("raw", F.lit("ch"), F.lit("C")), "cqw", "kkv")
    # A token of several names is a name people bear, not a slip of one.
    known = units.filter(~has_initials()).select("canon", F.explode(F.split(alike, " ")).alias("changed")).groupBy("changed").agg(F.countDistinct("canon").alias("known")).filter("known > 1")
    letters = F.transform(F.sequence(F.lit(1), F.length("changed")), lambda i: F.concat(F.substring("changed", F.lit(1), i - 1), F.substring("changed", i + 1, F.length("changed"))))
    forms = F.explode(F.array_distinct(F.concat(F.array("changed"), letters))).alias("form")
    spread = split.join(shared.hint("merge"), block).join(known.hint("merge"), "changed", "left").repartition(shuffle_width(units.sparkSession), "unit")
    made = spread.select("unit", "canon", "n_keys", "kept", "changed", "middle", "known", "state", forms).filter("form <> ''").withColumn("h", F.xxhash64("state", "kept", "form"))
    bearers = F.size(F.collect_set("canon").over(Window.partitionBy("h")))
    # What a form says of any two of its bearers; if that and a shared constituency don't suffice, no pair does.
    says = F.least(F.length("kept"), F.lit(KEPT_LETTERS)) + F.length("form") - F.log2(F.greatest(F.col("bearers") - 1, F.lit(1)))
    seen = cut(made.withColumn("bearers", bearers).filter("bearers > 1").withColumn("says", says).filter(F.col("says") + SAME_PLACE >= SLIP_SCORE).select("h", "unit", "canon", "n_keys", "changed", "middle", "known", "says"))
    # The bearers of each constituency and, with no place, of the state; both are held against each other in one join.
    here = seen.join(places.hint("merge"), "unit")
    return _near_slips(cut(here.unionByName(seen.filter(F.col("says") >= SLIP_SCORE).withColumn("place", F.lit("")))))


def _near_slips(bearers: DataFrame) -> DataFrame:
    """(a, b): units of one form h and place that the score links; as many as join what all such pairs join, a pair more than once.

    Without a place, an empty string, nothing is added to the score for a shared one.

    In a group, all that tells the bearers of one name in one writing from each other is ``n_keys``, and the score falls
    with the lesser of two. So each bearer is held against the one of the fewest keys of every other name and writing:
    if any two of two writings are linked, so are these two, and each of the two with that of the other writing.
    """
    writing = ["canon", "changed", "middle", "known"]
    by = ["h", "place"]
    least = bearers.groupBy(*by, *writing).agg(F.min(F.struct("n_keys", "unit")).alias("m"))
    others = least.select(*by, *[F.col(c).alias(f"other_{c}") for c in writing], F.col("m.unit").alias("other"), F.col("m.n_keys").alias("other_n_keys"))
    pairs = bearers.join(others.hint("merge"), by).filter("canon <> other_canon")
    first = F.substring("changed", 1, 1) != F.substring("other_changed", 1, 1)
    longer, shorter = (F.when((F.length("changed") > F.length("other_changed")) == flag, F.col("changed")).otherwise(F.col("other_changed")) for flag in (True, False))
    ending = (F.length("changed") != F.length("other_changed")) & longer.startswith(shorter) & F.substring(longer, -1, 1).isin(*"aeiou")
    letters_of = lambda c: F.array_sort(F.split(F.col(c), ""))
    other = (F.length("changed") == F.length("other_changed")) & (letters_of("changed") != letters_of("other_changed"))
    middles_differ = (F.col("middle") != F.col("other_middle")) & (F.col("middle") != "") & (F.col("other_middle") != "")
    off = lambda condition, cost: F.when(condition, cost).otherwise(0)
    common = lambda c: F.col(c).isin(*COMMON_NAMES.split())
    # least and greatest pass over nulls, so a token that isn't known is made one.
    both = [F.when(F.col(a).isNotNull(), F.col(b)) for a, b in (("known", "other_known"), ("other_known", "known"))]
    score = (
        F.col("says")
        + F.when(F.col("place") != "", SAME_PLACE).otherwise(0)
        - off(other, OTHER_LETTER)
        - off(first, FIRST_LETTER)
        - off(ending, END_VOWEL)
        - off(middles_differ, OTHER_MIDDLE)
        - F.when(common("changed") & common("other_changed"), BOTH_KNOWN).otherwise(F.coalesce(BOTH_KNOWN * F.least(*both) / F.greatest(*both), F.lit(0)))
        - F.log2(F.least("n_keys", "other_n_keys"))
    )
    return pairs.filter(score >= SLIP_SCORE).select(F.least("unit", "other").alias("a"), F.greatest("unit", "other").alias("b"))


def short_edges(forms: DataFrame, places: DataFrame) -> DataFrame:
    """(a, b): persons of whom one has a short name that, in the constituency or else in the state, only the other's full name gives.

    ``forms`` has unit, person, kind, role, letters and the form's number h; it is read more than once.
    """
    brief = forms.filter("role = 'b'")
    # Full names matter only where somebody has the short form.
    wide = forms.filter("role = 'w'").join(brief.select("h").distinct().hint("merge"), "h", "left_semi")
    # Both are looked up in the constituency (near) and in the state, in one join.
    local = lambda df: df.join(places.hint("merge"), "unit").withColumn("h", F.xxhash64("h", "place")).drop("place").withColumn("near", F.lit(1))
    both = lambda df: local(df).unionByName(df.withColumn("near", F.lit(0)))
    asked = cut(both(brief.select("unit", "person", "kind", "letters", "h")).filter(F.col("letters") + SAME_PLACE * F.col("near") >= SHORT_SCORE).drop("unit"))
    full = cut(both(wide.select("unit", "person", "h")).groupBy("near", "h").agg(F.min("person").alias("a"), F.max("person").alias("z")))
    met = asked.join(full.filter("a = z").hint("merge"), ["near", "h"]).select("person", "a", "near").filter("person <> a")
    # A person met in the constituency comes before one met in the state; two different ones link neither.
    chosen = met.groupBy("person", "near").agg(F.min("a").alias("a"), F.max("a").alias("z")).groupBy("person").agg(F.max(F.struct("near", "a", "z")).alias("m")).filter("m.a = m.z").select(F.col("m.a").alias("a"), F.col("person").alias("b"))
    # Short names of one constituency that no full name there bears are one person.
    alone = asked.filter("near = 1 AND kind IN ('I', 'M')").join(full.filter("near = 1").select("h").hint("merge"), "h", "left_anti")
    return chosen.unionByName(_stars(alone, "h", "person"))


def link_names(records: DataFrame) -> DataFrame:
    """(key, name, person): the records with the person they belong to, a number.

    ``records`` has key, name, state and place (both may be null). Records without a usable name
    are left out.
    """
    # Every join below is a merge: what is broadcast passes through the driver.
    named = cut(records.filter(F.regexp_replace("name", r"[^\p{L}]+", "") != "").select("key", "name", place_key(F.col("state")).alias("state"), place_key(F.col("place")).alias("place")).distinct())
    read = _read(named.select("state", "place", "name").distinct())
    # Initials are no proof beyond the constituency.
    scope = F.when(has_initials() | F.col("state").isNull(), F.coalesce("place", F.lit(""))).otherwise("")
    read = read.withColumn("unit", F.xxhash64(F.coalesce("state", F.lit("")), scope, "tokens", "told"))
    on = [F.col(f"n.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("state", "place")]
    rows = cut(named.alias("n").join(read.alias("r").hint("merge"), [F.col("n.name") == F.col("r.name"), *on]).select("key", "n.name", "n.state", "n.place", "unit", "tokens", "raw", "told"))
    by_spelling = rows.groupBy("unit", "state", "tokens", "told", "raw").agg(F.min("place").alias("a_place"), F.countDistinct("key").alias("n"))
    most = F.min_by("raw", F.struct(-F.col("n"), F.length("raw"), F.col("raw"))).alias("raw")
    units = cut(by_spelling.groupBy("unit", "state", "tokens", "told").agg(most, F.min("a_place").alias("a_place"), F.sum("n").alias("n_keys")).withColumn("canon", F.xxhash64(F.array_sort(F.split("tokens", " ")))))
    places = cut(rows.filter("place IS NOT NULL AND state IS NOT NULL").select("unit", "place").distinct())

    forms = _exploded(units, ["unit", "state", "a_place", "tokens"], lambda tokens, raw, told: [(f,) for f in full_forms(tokens, raw)], "form string")
    initials = has_initials()
    within = F.concat_ws("|", "state", F.when(initials, F.col("a_place")))
    proves = ~initials | F.col("a_place").isNotNull()
    forms = cut(forms.select("unit", "state", proves.alias("proves"), F.xxhash64(within, "form").alias("h"), F.xxhash64("form").alias("anywhere"), initials.alias("initials")))
    placed = forms.filter("state IS NOT NULL")
    # A name without its middle name: where one canonical form has that middle name.
    short = _exploded(units.filter("state IS NOT NULL"), ["unit", "state", "canon"], short_forms, "role string, form string, letters int")
    short = cut(short.select("unit", F.substring("form", 1, 1).alias("kind"), "role", "letters", F.xxhash64("state", "form").alias("h"), "canon"))
    middles = short.filter("kind IN ('P', 'G')")
    whole = middles.filter("role = 'w'").groupBy("h").agg(F.min("unit").alias("a"), F.min("canon").alias("c"), F.max("canon").alias("d")).filter("c = d").select("h", "a")
    middle_edges = middles.filter((F.col("role") == "b") & (F.col("letters") >= SHORT_SCORE)).join(whole.hint("merge"), "h").select("a", F.col("unit").alias("b"))
    # One key is one person, whatever its rows say.
    by_key = _stars(rows.select("unit", F.xxhash64("key").alias("h")), "h", "unit")
    same = _stars(placed.filter("proves"), "h", "unit").unionByName(by_key).unionByName(middle_edges).unionByName(slip_edges(units, places))
    persons = cut(_labelled(units.select("unit", F.col("unit").alias("person")), "person", same))
    # Nicknames come first: an initial links where all full bearers are one person by then.
    nicks = cut(short_edges(cut(short.filter("kind IN ('N', 'P', 'G')").join(persons.hint("merge"), "unit")), places))
    hop = nicks.groupBy(F.col("b").alias("person")).agg(F.min("a").alias("a"))
    by_nick = persons.join(hop.hint("merge"), "person", "left").select("unit", F.coalesce("a", "person").alias("person"))
    weak = nicks.unionByName(short_edges(cut(short.filter("kind IN ('I', 'M')").join(by_nick.hint("merge"), "unit")), places))

    # Without a state: full forms that occur in one state alone.
    homeless = forms.filter("state IS NULL AND NOT initials").select("unit", "anywhere")
    homes = placed.filter("NOT initials").join(homeless.select("anywhere").distinct().hint("merge"), "anywhere", "left_semi")
    one_state = homes.groupBy("anywhere").agg(F.min("state").alias("s"), F.max("state").alias("t"), F.min("unit").alias("a")).filter("s = t").select("anywhere", "s", "a")
    offers = homeless.join(one_state.hint("merge"), "anywhere").groupBy("unit").agg(F.min("s").alias("s"), F.max("s").alias("t"), F.collect_set("a").alias("a"))
    of = lambda c: persons.select(F.col("unit").alias(c), F.col("person").alias(f"{c}_person"))
    lost = offers.filter("s = t").select(F.explode("a").alias("a"), "unit").join(of("a").hint("merge"), "a").join(of("unit").hint("merge"), "unit").select(F.col("a_person").alias("a"), F.col("unit_person").alias("b"))

    merged = _labelled(persons, "person", weak.unionByName(lost))
    return rows.join(merged.hint("merge"), "unit").select("key", "name", "person").distinct()


def spelling_pairs(linked: DataFrame) -> DataFrame:
    """(left_key, right_key): the records of one person whose names aren't the same string, once each."""
    left = linked.select("person", F.col("key").alias("left_key"), F.col("name").alias("left_name"))
    right = linked.select("person", F.col("key").alias("right_key"), F.col("name").alias("right_name"))
    pairs = left.join(right, "person").filter("left_key < right_key AND left_name <> right_name")
    return pairs.select("left_key", "right_key").distinct()
