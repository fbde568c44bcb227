import math
import random

import pytest

pytest.importorskip("worktally.llm.canonical")
from worktally.llm import components, names
from worktally.llm.canonical import map_values
from worktally.llm.components import connected_components
from worktally.llm.names import full_forms, link_names, parse_name, short_forms, slip_edges, sound, spelling_pairs, spelt
from worktally.llm.setjoin import similarity_join


def test_similarity_join_against_brute_force(spark):
    rng = random.Random(3)
    make = lambda n: [(str(i), rng.sample("abcdefghijkl", rng.randint(0, 7))) for i in range(n)]
    left, right = make(60), make(40)
    frame = lambda rows: spark.createDataFrame([(*r, "clash", 1) for r in rows], "id string, tokens array<string>, token string, n int")
    for t in (0.4, 0.5, 0.8, 1.0):
        want = {}
        for i, a in left:
            for j, b in right:
                if a and b and len(set(a) & set(b)) / len(set(a) | set(b)) >= t - 1e-9:
                    want[i, j] = len(set(a) & set(b)) / len(set(a) | set(b))
        got = {(r.left_id, r.right_id): r.jaccard for r in similarity_join(frame(left), frame(right), t).collect()}
        assert got == pytest.approx(want)


def test_similarity_join_of_empty_sides(spark):
    empty = spark.createDataFrame([], "id string, tokens array<string>")
    one = spark.createDataFrame([("1", ["a"]), ("2", None)], "id string, tokens array<string>")
    assert similarity_join(empty, one, 0.5).count() == 0 and similarity_join(one, one, 0.5).count() == 1


REFERENCE = [("activity", 1, "Construction of community hall"), ("activity", 2, "Installation of hand pump"), ("activity", 3, "Construction of boys hostel"), ("activity", 4, "Construction of girls hostel"), ("category", 9, "Drinking Water")]


def test_typed_values_find_their_entry(spark):
    ref = spark.createDataFrame(REFERENCE, "kind string, ref_id int, name string")
    typed = {
        "WS/MP12/2020-2021/7-Constn of community hall": 1,
        "community hall, construction": 1,
        "Construcion of comunity hal": 1,
        "INSTALLATION OF HANDPUMP near Somepur": 2,
        "Construction of bous hostel": 3,
        "Construction of girls chhatravas": 4,
        "Printing of calendars": 0,
        "construction": 0,
        "-": 0,
        "500000": 0,
        "x" * 5000: 0,
    }
    values = [("activity", v, "c") for v in [*typed, *typed, None]] + [("category", "Peyjal", "c"), ("category", "Drnking  Wter", "c"), ("category", "Industry", "c")]
    got = map_values(spark.createDataFrame(values, "kind string, value string, core string"), ref).collect()
    assert {r.value: r.ref_id for r in got if r.kind == "activity"} == typed
    assert {r.value: r.ref_id for r in got if r.kind == "category"} == {"Peyjal": 9, "Drnking  Wter": 9, "Industry": 0}


def test_a_join_by_units_keeps_every_pair_that_can_agree(spark):
    rng = random.Random(5)
    left = [(str(i), rng.sample("abcdefghijkl", rng.randint(0, 9)), rng.randint(1, 12)) for i in range(80)]
    right = [(str(i), rng.sample("abcdefghijkl", rng.randint(0, 6))) for i in range(50)]
    for t in (0.3, 0.5, 1.0):
        # The most that c <= units and c <= common can give by position.
        most = lambda a, n, b: min(n, len(set(a) & set(b)))
        want = {(i, j) for i, a, n in left for j, b in right if a and b and most(a, n, b) / (n + len(b) - most(a, n, b)) >= t - 1e-9}
        got = similarity_join(spark.createDataFrame(left, "id string, tokens array<string>, units int"), spark.createDataFrame(right, "id string, tokens array<string>"), t, "units")
        assert {(r.left_id, r.right_id) for r in got.collect()} == want


def test_alternatives_of_a_word_cost_no_entry(spark):
    names = ["Repair of village meeting platform", "Heating plant", "Seating", "Beating retreat", "Fencing", "Setting", "Rating", "Resting shed", "Renting", "Retting tank", "Greeting hall", "Eating house", "Netting", "Betting", "Letting", "Reading room"]
    ref = spark.createDataFrame([("activity", i, n) for i, n in enumerate(names, 1)], "kind string, ref_id int, name string")
    got = map_values(spark.createDataFrame([("activity", "Repair of village reting platform 2 nos")], "kind string, value string"), ref).first()
    assert (got.ref_id, got.score) == (1, 1.0)


def test_mapping_of_empty_tables(spark):
    ref = spark.createDataFrame(REFERENCE, "kind string, ref_id int, name string")
    values = spark.createDataFrame([("activity", "hand pump")], "kind string, value string")
    assert map_values(values.limit(0), ref).count() == 0
    assert [r.ref_id for r in map_values(values, ref.limit(0)).collect()] == [0]


def test_components_against_union_find(spark):
    rng = random.Random(6)
    edges = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(90)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in list(parent)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_components_in_rounds_are_those_of_one_task(spark, monkeypatch):
    rng = random.Random(7)
    edges = [(rng.randint(-90, 90), rng.randint(-90, 90)) for _ in range(70)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (None, 3), (2**62, -(2**62))]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = []
    for most in (components.ONE_TASK_EDGES, 0):
        monkeypatch.setattr(components, "ONE_TASK_EDGES", most)
        found.append(sorted(tuple(r) for r in connected_components(df).select("node", "label").collect()))
    assert found[0] == found[1] and len(found[0]) > 100


def test_components_make_their_edges_once(spark):
    """What makes them may be a long plan."""
    made = spark.sparkContext.accumulator(0)

    def run(batches):
        for pdf in batches:
            made.add(len(pdf))
            yield pdf

    edges = spark.createDataFrame([(i, i + 1) for i in range(20)], "a bigint, b bigint").mapInPandas(run, "a bigint, b bigint")
    assert connected_components(edges).filter("label = 0").count() == 21
    assert made.value == 20


def test_linking_takes_few_jobs(spark):
    """Each job leaves plans, threads and results on the driver."""
    sc = spark.sparkContext
    sc.setJobGroup("linking", "")
    try:
        assert link_names(spark.createDataFrame(PEOPLE, "key string, name string, state string, place string")).count() == 12
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(sc.statusTracker().getJobIdsForGroup("linking"))
    assert jobs <= 120


def test_names_are_parsed():
    assert parse_name("Shri. HALDEKAR, HADHUNISH (2019-24)") == (["hadhunish", "haldekar"], True)
    assert parse_name("Hon'ble Dr. Ram  Nath ji") == (["ram", "nath"], False)
    assert parse_name("VizokeshZegholoth Dulavwal ji")[0] == ["vizokesh", "zegholoth", "dulavwal"]
    assert parse_name("Háldwal T. O.")[0] == ["haldwal", "t", "o"]
    assert sound("kootidhar") == sound("kutidar") and sound("haldecar") == sound("haldekar")
    assert spelt("123 !") == ([], False)
    assert full_forms(*[parse_name("Ram Acme Pvt. Ltd.")[0]] * 2)[0] == "all acme ltd pvt ram"
    assert len(full_forms(["x" * 3000], ["x" * 3000])) < 10
    assert ("b", "N bil smith", 9) in short_forms(["bil", "smith"], ["bill", "smith"], True) and ("w", "N bil smith", 0) in short_forms(["viliam", "smith"], ["william", "smith"], True)


S, P = "Somestate", "Someplace"
PEOPLE = [
    ("a:1", "Kutidhar Iravekar", S, P),
    ("a:2", "IRAVEKAR, KUTIDHAR", S, P),
    ("a:3", "KUTIDHARIRAVEKAR", S, P),
    ("a:4", "Prof kuti iravekar", S, P),
    ("a:5", "K. Iravekar", S, P),
    ("a:6", "Kutidhra Iravekar", S, "Other"),
    ("a:7", "Kootidhar Iravekar ji (2019-24)", S.upper(), None),
    ("b:1", "Kutidhar Iravekar", "Elsewhere", "Far"),
    ("b:2", "KUTIDHAR IRAVEKAR", "Elsewhere", "Far"),
    ("c:1", "Radhujit Iravamb", S, P),
    ("c:1", "Radhujit  Iravamb", None, None),
    ("c:2", "Somename Elseone", None, None),
    ("c:3", None, S, P),
    ("c:4", "  ", S, P),
    ("c:5", "???", S, P),
]


def test_spellings_of_one_person_are_linked(spark):
    df = spark.createDataFrame([(*p, 1, "x") for p in PEOPLE], "key string, name string, state string, place string, node int, person string")
    linked = link_names(df)
    groups = {}
    for r in linked.collect():
        groups.setdefault(r.person, set()).add(r.key)
    assert sorted(map(sorted, groups.values())) == [["a:1", "a:2", "a:3", "a:4", "a:5", "a:6", "a:7"], ["b:1", "b:2"], ["c:1"], ["c:2"]]
    pairs = {tuple(r) for r in spelling_pairs(linked).collect()}
    assert ("b:1", "b:2") in pairs and len(pairs) == 21 + 1 and all(a < b for a, b in pairs)


def test_an_initial_borne_by_two_people_links_neither(spark):
    rows = [("a:1", "Kutidhar Iravekar", S, P), ("a:2", "Kalomala Iravekar", S, P), ("a:3", "K. Iravekar", S, P)]
    df = spark.createDataFrame(rows, "key string, name string, state string, place string")
    assert link_names(df).select("person").distinct().count() == 3
    assert spelling_pairs(link_names(df.limit(0))).count() == 0


def _components(edges):
    """The sets of nodes that ``edges`` join."""
    of = {}
    for a, b in edges:
        both = of.get(a, {a}) | of.get(b, {b})
        of |= dict.fromkeys(both, both)
    return {frozenset(x) for x in of.values()}


def _slips(units, places):
    """Every pair of units of two names that the score links, each form held against each other one."""
    known, blocks, out = {}, {}, set()
    for unit, canon, state, tokens, raw, told, n_keys in units:
        words = tokens.split(" ")
        for token in raw.replace("ch", "C").translate(str.maketrans("cqw", "kkv")).split(" ") if all(len(t) > 1 for t in words) else []:
            known.setdefault(token, set()).add(canon)
        for g, f, m in names.readings(words, told):
            for k, c in ((g, f), (f, g)) if len(words[g]) > 1 and len(words[f]) > 1 else ():
                for x in names.letters_alike(raw.split(" ")[c]):
                    for form in {x} | {x[:i] + x[i + 1 :] for i in range(len(x))}:
                        blocks.setdefault((state, words[k], form), set()).add((unit, canon, x, words[m[0]][0] if m else "", n_keys))
    heads = {t: len(c) for t, c in known.items() if len(c) > 1}
    common = names.COMMON_NAMES.split()
    for (_, kept, form), rows in blocks.items():
        bearers = len({r[1] for r in rows})
        for u, canon, x, m, n in rows:
            for v, other, y, w, k in rows:
                if canon != other:
                    long, short = (x, y) if len(x) > len(y) else (y, x)
                    score = min(len(kept), 5) + len(form) + 4 * bool(places[u] & places[v]) - 4 * (x[0] != y[0]) - 4 * bool(m and w and m != w)
                    score -= 8 * (len(x) != len(y) and long.startswith(short) and long[-1] in "aeiou") + 2 * (len(x) == len(y) and sorted(x) != sorted(y))
                    score -= 6 if x in common and y in common else 6 * min(heads[x], heads[y]) / max(heads[x], heads[y]) if x in heads and y in heads else 0
                    if score - math.log2(max(bearers - 1, 1)) - math.log2(min(n, k)) >= 9:
                        out.add((min(u, v), max(u, v)))
    return out


def test_slips_join_all_that_the_score_links(spark):
    """Not only the bearers that the score links to the best attested one."""
    rng = random.Random(8)
    units, canons = {}, {}
    for _ in range(420):
        given, family = rng.choice(["Kutidhar", "Radhujit", "Somavik", "Ramesh", "Anita"]), rng.choice(["Iravekar", "Wenakud", "Lal"])
        for _ in range(rng.choice([0, 1, 1, 1])):
            i = rng.randrange(len(given))
            given = rng.choice([given[:i] + given[i + 1 :], given[:i] + rng.choice("aeoxy") + given[i + 1 :], given[:i] + rng.choice("aeoxy") + given[i:]])
        raw, told = f"{given} {rng.choice(['', '', 'k ', 'naru ', 'tapan '])}{family}".lower().split(), rng.random() < 0.5
        tokens = " ".join(t if len(t) == 1 else sound(t) for t in raw)
        canon = canons.setdefault(" ".join(sorted(tokens.split())), len(canons))
        state = rng.choice("st")
        units.setdefault((tokens, told, state, rng.choice("pq") if " k " in tokens else ""), (len(units), canon, state, tokens, " ".join(raw), told, rng.choice([1, 1, 2, 9, 70])))
    rows = list(units.values())
    places = {r[0]: set(rng.sample("pqrsuvw", rng.choice([0, 1, 1, 2]))) for r in rows}
    df = spark.createDataFrame(rows, "unit bigint, canon bigint, state string, tokens string, raw string, told boolean, n_keys bigint")
    edges = {tuple(r) for r in slip_edges(df, spark.createDataFrame([(u, p) for u, ps in places.items() for p in ps], "unit bigint, place string")).collect()}
    want = _slips(rows, places)
    assert len(want) > 100 and {(min(e), max(e)) for e in edges} <= want
    assert _components(edges) == _components(want)


def test_slips_are_linked_beside_a_better_attested_name_elsewhere(spark):
    rows = [(f"far:{i}", "Ramya Wenakud", S, "Farplace") for i in range(5)] + [("near:1", "Ramyo Wenakud", S, P), ("near:2", "Ramye Wenakud", S, P)]
    got = _persons(spark, rows)
    assert got["near:1"] == got["near:2"] != got["far:0"]


APART = [("Ramesh Kumar", "Rajesh Kumar"), ("Sunil Kumar", "Sushil Kumar"), ("Mohan Lal", "Sohan Lal"), ("Kavita Devi", "Savita Devi"), ("Rajesh Yadav", "Rajendra Yadav"), ("Nagendra Singh", "Narendra Singh"), ("Ram Kumar Singh", "Ram Prasad Singh"), ("Santosh Gupta", "Santoshi Gupta"), ("Vinay Joshi", "Vijay Joshi")]


def _persons(spark, rows):
    found = link_names(spark.createDataFrame(rows, "key string, name string, state string, place string")).collect()
    return {r.key: r.person for r in found}


TOGETHER = [("William Smith", "Bill Smith"), ("Acme Pvt. Ltd.", "Acme Private Limited"), ("Rajendra Yadav", "Rajendra Yadv"), ("Om Prakash Tiwari", "TIWARI, Om P."), ("Bhupinder Chauhan", "Mr Bhupindre Chauhan"), ("Harmeet Kaur Gill", "Harmeet Gill")]


def test_names_that_differ_stay_apart_and_rewritings_come_together(spark):
    """One letter does not make two common names one, in one constituency or in two; orders, nicknames, legal forms and slips do not part one."""
    letters = "abcdefghij"
    rows = [(f"two:{i}:{j}", n, "Somestate", f"Place {letters[i]}{letters[j]}") for i, pair in enumerate(APART) for j, n in enumerate(pair)]
    rows += [(f"one:{i}:{j}", n, "Otherstate", "Place") for i, pair in enumerate(APART) for j, n in enumerate(pair)]
    rows += [(f"same:{i}:{j}", n, "Thirdstate", f"Place {letters[i]}") for i, pair in enumerate(TOGETHER) for j, n in enumerate(pair)]
    got = _persons(spark, rows)
    assert [pair for place in ("two", "one") for i, pair in enumerate(APART) if got[f"{place}:{i}:0"] == got[f"{place}:{i}:1"]] == []
    assert [pair for i, pair in enumerate(TOGETHER) if got[f"same:{i}:0"] != got[f"same:{i}:1"]] == []


GIVEN = "Ramesh Rajesh Suresh Mahesh Sunil Sushil Anil Mohan Sohan Kavita Savita Sunita Anita Narendra Nagendra Surendra Mahendra Rajendra Vijay Vinay Ajay Sanjay Deepak Ashok Harish Girish Lakshmi Parvati Meenakshi Balwinder Gurpreet Chandrashekhar Venkatesh Siddharth Bhagwati Dharmendra".split()
FAMILY = "Kumar Lal Devi Yadav Singh Sharma Chaudhary Bhattacharya Mukherjee Deshpande Kulkarni Venkataraman Subramanian Choudhury Raghuvanshi Thakur Nimbalkar Gaikwad".split()


def _written(rng, given, family):
    """A way to write a name, and whether it is no more than another order, case, title or spelling of a sound."""
    kind = rng.choice(["plain", "upper", "title", "comma", "joined", "term", "double", "slip", "slip", "initial", "nick"])
    full = f"{given} {family}"
    if kind == "slip":
        word, other = (given, family) if rng.random() < 0.5 else (family, given)
        i = rng.randrange(1, len(word) - 1)
        bad = rng.choice([word[:i] + word[i + 1 :], word[:i] + word[i + 1] + word[i] + word[i + 2 :]])
        return f"{bad} {family}" if word == given else f"{given} {bad}"
    return {"plain": full, "upper": full.upper(), "title": f"Shri. {full} ji", "comma": f"{family}, {given}", "joined": given + family, "term": f"{full} (2019-24)", "double": full.replace("a", "aa", 1), "initial": f"{given[0]}. {family}", "nick": f"{given[:4]}u {family}" if len(given) > 5 else full}[kind]


def test_precision_and_recall_on_held_out_names(spark):
    """Common names, unlike those the rules were made on; each person keeps to one constituency."""
    rng = random.Random(20)
    people = rng.sample([(g, f) for g in GIVEN for f in FAMILY], 240)
    rows, truth = [], {}
    for n, (given, family) in enumerate(people):
        state = f"State {'abcdefghijkl'[n % 12]}"
        for k in range(rng.randint(2, 7)):
            key = f"a:{n}:{k}"
            truth[key] = n
            rows.append((key, _written(rng, given, family), state, f"Place {''.join('abcdefghij'[int(d)] for d in str(n))}" if rng.random() < 0.9 else None))
    got = _persons(spark, rows)
    pairs = lambda groups: {(a, b) for ks in groups.values() for a in ks for b in ks if a < b}

    def grouped(of):
        out = {}
        for key, who in of.items():
            out.setdefault(who, []).append(key)
        return out

    true, found = pairs(grouped(truth)), pairs(grouped(got))
    precision, recall = len(true & found) / len(found), len(true & found) / len(true)
    print(f"precision {precision:.3f} recall {recall:.3f} of {len(true)}")
    assert precision >= 0.95 and recall >= 0.95
