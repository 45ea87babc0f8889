"""Names, addresses, establishments: parsers on cases, clusters and joins on small tables."""

import random

import numpy as np
import pytest

from entitylink.llm import addresses, establishments, names, variants
from entitylink.llm.shared import Stage, ship

from .test_core_ops import live


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("Katherine Zepenunpre & Sons Electrical Contractors", "Kate Zepenunpre + Sons Elec Contr., LLC"), ("www.debrunlepranelectronics.example", "Debrunlepran Electronics Private Limited"),
        ("HZFS (Hawun Zunpu Flower Shop)", "Hawun Zunpu Flower Shop Inc"), ("Dovegrorda Metzgerei (Head Office)", "Metzgerei Dovegrorda"), ("Brors3lbigran, Hardware", "Hardware Brorselb1gran #39"),
        ("Établissements Lugun Pidro SAS", "Ets Lugun Pidro"), ("СЕРВИЗ ГРЕБРАНКИРОР ЕООД", "Сервиз Гребранкирор"), ("The Viszafel Plumbing Limited Liability Co", "Viszafel Plumbing Company"),
    ],
)
def test_same_spelling(a, b):
    x, y = names.parse_name(a), names.parse_name(b)
    assert (x[3], x[2]) == (y[3], y[2])
    assert variants.givens_agree(x[1], y[1])


def test_lines_and_given_names_tell_apart():
    x, y = names.parse_name("Bugu Kidis Dental Clinic"), names.parse_name("Bugu Kidis Plumbing Company")
    assert x[3] == y[3] and not variants.lines_agree(x[2], y[2])
    assert not variants.givens_agree("elizabeth", "robert") and variants.givens_agree("e", "elizabeth") and not variants.givens_agree("", "robert")


def test_odd_names():
    for t in ("", " ", "​", "()", "Ltd", "123", "x" * 5000, "& Sons"):
        assert len(names.parse_name(t)) == 4


def test_slips():
    assert variants.slips("pranprel", "pranprle") == 1 and variants.slips("hobrel", "hovrel") == 1 and variants.slips("kigrel", "kgrel") == 1
    assert variants.slips("klopan", "klepan") == 2 and variants.slips("abc", "abc") == 0


def brute_linkage(sim, least):
    groups = [[i] for i in range(len(sim))]
    while len(groups) > 1:
        best = max(((np.mean([sim[a][b] for a in x for b in y]), -i, -j) for i, x in enumerate(groups) for j, y in enumerate(groups) if i < j))
        if best[0] < least:
            break
        i, j = -best[1], -best[2]
        groups[i] += groups.pop(j)
    return {frozenset(g) for g in groups}


def random_similarity(n, seed):
    rng = np.random.default_rng(seed)
    m = np.round(rng.random((n, n)), 3)
    m = np.triu(m, 1) * (rng.random((n, n)) < 0.6)
    return m + m.T


@pytest.mark.parametrize("seed", range(6))
def test_average_linkage(seed):
    sim = random_similarity(9, seed)
    label = variants.average_linkage(sim, 0.45)
    got = {frozenset(np.flatnonzero(label == k)) for k in set(label)}
    assert got == brute_linkage(sim, 0.45)


def test_linkage_rounds_equal_one_task(spark):
    sim = random_similarity(12, 3)
    edges = [(i, j, float(sim[i, j])) for i in range(12) for j in range(i + 1, 12) if sim[i, j] > 0]
    got = variants.linkage_rounds(spark.range(12).withColumnRenamed("id", "sid"), spark.createDataFrame(edges, "a bigint, b bigint, s double"), Stage(spark, "t"), 0.45)
    groups = {}
    for r in got.collect():
        groups.setdefault(r.org, set()).add(r.sid)
    assert {frozenset(g) for g in groups.values()} == brute_linkage(sim, 0.45)


def test_large_components_equal_one_task(spark, monkeypatch):
    """One organisation a line, slips, initials and names without a line: the distributed way gives what one task gives."""
    ship(spark)
    rng = random.Random(5)
    lines, heads = ["Bakery", "Plumbing", "Dental Clinic", "", ""], ["", "", "Katherine ", "Robert ", "R. "]
    texts = {f"Gorfuwelbran {line}".strip() for line in lines}
    for _ in range(150):
        brand = list(rng.choice(["Gorfuwelbran", "Gorfuwelpran", "Hupristrorel"]))
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            at = rng.randrange(1, len(brand) - 1)
            brand[at : at + 2] = rng.choice([brand[at : at + 2][::-1], brand[at : at + 1], [brand[at], *brand[at : at + 2]]])
        texts.add(f"{rng.choice(heads)}{''.join(brand)} {rng.choice(lines)}".strip())
    recs = spark.createDataFrame([(t, None) for t in sorted(texts)], "name string, addr string")
    one_task = organisation_groups(spark, recs)
    assert 5 < len(one_task) < len(texts)
    for most in (1, 5):
        monkeypatch.setattr(variants, "IN_ONE_TASK", most)
        assert organisation_groups(spark, recs) == one_task
    monkeypatch.setattr(variants, "IN_ONE_TASK", 1500)
    monkeypatch.setattr(variants, "HOT_KEY", 3)
    monkeypatch.setattr(variants, "TOP_N", 1)
    assert organisation_groups(spark, recs) == one_task


def organisation_groups(spark, recs):
    out = {}
    for r in variants.organisations(recs, Stage(spark, "t")).collect():
        out.setdefault(r.org, set()).add(r.name)
    return {frozenset(g) for g in out.values()}


def test_similar_spellings_against_all_pairs(spark):
    """The keyed join finds every pair of a few hundred spellings that reaches the cosine and that slips explain."""
    ship(spark)
    rng = random.Random(11)
    syllables = ["bor", "gun", "pre", "la", "kis", "vu", "dran", "tel", "mo", "fi"]
    brands = ["".join(rng.choices(syllables, k=rng.choice([2, 3, 3, 4]))) for _ in range(60)]
    rows = {("", "", "gorfuwelbran")}
    for b in brands:
        for _ in range(5):
            w = list(b)
            for _ in range(rng.choice([0, 1, 1, 2])):
                at = rng.randrange(1, len(w) - 1)
                w[at : at + 2] = rng.choice([w[at : at + 2][::-1], w[at : at + 1], [w[at], *w[at : at + 2]]])
            rows.add((rng.choice(["", "", "robert"]), rng.choice(["", "bakery", "plumbing company"]), "".join(w)))
    parts = spark.createDataFrame([(i, "", *r) for i, r in enumerate(sorted(rows))], "sid bigint, brand string, given string, line string, folded string")
    got = {(r.a, r.b): r.s for r in variants.similar_spellings(parts, Stage(spark, "t")).collect()}
    grams = lambda w: {f"^{w}$"[i : i + 3] for i in range(len(w))}
    n = len(rows)
    df = {}
    for r in rows:
        for g in grams(r[2]):
            df[g] = df.get(g, 0) + 1
    total = n + variants.PRIOR
    weight = {g: min(255, int(10 * np.log1p(total / (k + variants.SMOOTHING * total)) ** 2 + 0.5)) for g, k in df.items()}
    expected = {}
    for i, x in enumerate(sorted(rows)):
        for j, y in enumerate(sorted(rows)):
            if i < j and variants.lines_agree(x[1], y[1]) and variants.givens_agree(x[0], y[0]) and variants.slips(x[2], y[2], 2.0) <= variants.allowed_slips(x[2], y[2]):
                a, b = grams(x[2]), grams(y[2])
                cosine = sum(weight[g] for g in a & b) / np.sqrt(float(sum(weight[g] for g in a) * sum(weight[g] for g in b)))
                if round(1000 * cosine) >= 450:
                    expected[i, j] = round(1000 * cosine)
    assert len(expected) > 100 and got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) <= 1 for k in got)


def test_near_forms_against_all_pairs(spark):
    """Every pair that slips explain is found, of short brands and of those around and above the length with keys of all deletions."""
    ship(spark)
    rng = random.Random(21)
    letters = "aeiklnorst"
    brands = {"".join(rng.choices(letters, k=n)) for n in [4, 5, 6, 7, 8, 9, 12, 21, 22, 23, 24, 25, 26, 27, 40] for _ in range(4)} | {"x" * 3000}
    for b in sorted(brands):
        for _ in range(8):
            w = list(b)
            for _ in range(rng.choice([1, 2, 2])):
                at = rng.randrange(len(w) - 1)
                w[at : at + 2] = rng.choice([w[at : at + 2][::-1], w[at : at + 1], [w[at], *w[at : at + 2]], [w[at], rng.choice(letters)]])
            brands.add("".join(w))
    rows = [(i, b, rng.choice(["", "bakery", "law"]), rng.random() < 0.2) for i, b in enumerate(sorted(brands))]
    forms = spark.createDataFrame(rows, "form bigint, folded string, block string, has boolean")
    got = [tuple(r) for r in variants.near_forms(forms).collect()]
    allowed = lambda x, y: variants.slips(x[1], y[1], 2.0) <= variants.allowed_slips(x[1], y[1]) and x[3] == y[3] and (x[2] == y[2] or "" in (x[2], y[2]))
    expected = {(x[0], y[0]) for x in rows for y in rows if x[0] < y[0] and abs(len(x[1]) - len(y[1])) <= 2 and allowed(x, y)}
    assert len(expected) > 200 and len(got) == len(set(got)) and set(got) == expected


def test_pairs_compared_follow_pairs_found():
    """Brands of few syllables, all with one ending, share many runs of letters; keys of four times the brands bring few of them together."""
    rng = random.Random(4)
    syllables = [c + v for c in "bdfghklmnprstvwz" for v in "aeiou"]
    brands = sorted({"".join(rng.choices(syllables, k=4)) + "bran" for _ in range(1200)})
    seen = {}
    for i, keys in enumerate(variants.deletion_keys(brands)):
        assert len(keys) == len({w for n in range(3) for w in rests(brands[i], n)})
        for k in keys:
            seen.setdefault(k, []).append(i)
    assert len({(x, y) for at in seen.values() for x in at for y in at if x < y}) < len(brands)


def rests(word, n):
    return {word} if n == 0 else {w[:i] + w[i + 1 :] for w in rests(word, n - 1) for i in range(len(w))}


def test_slips_in_tables_of_a_few_names(spark):
    """One swap, with the line and without, in a table of four names; a town at the end is no part of a name."""
    recs = spark.createDataFrame(
        [("Harrison Bakery", "1 Mill Road, Lorliville"), ("Harrsion Bakery", None), ("Harrsion", ""), ("Harrison Bakery Lorliville Ltd", "9 Mill Road, Lorliville"), ("Gorfuwel Plumbing", "3 Mill Road")], "name string, addr string"
    )
    assert organisation_groups(spark, recs) == {frozenset({"Harrison Bakery", "Harrsion Bakery", "Harrsion", "Harrison Bakery Lorliville Ltd"}), frozenset({"Gorfuwel Plumbing"})}


ROWS = [
    ("S1-1", "Mordra Brunbrel Brewery Ltd", "12 Gorfuwel Court, Suite 4, Lorliville, WB 32218", "S2-1", "Mordra Brunbrel, Brewery", "Suite 4, 0012 Gorfuwel Ct, Lorliville, WB 32218", 1.0, 1),
    ("S1-1", None, None, "S2-2", "Mordra Burnbrel Brewery", "12 Gorfuwel Crt., near Old Mill, Lorliville", 1.0, 1),
    ("S1-2", "Mordra Brunbrel Bakery", "12 Gorfuwel Court, Suite 5, Lorliville, WB 32218", "S3-1", None, "N/A", 1.0, 1),
    ("S1-3", "Mordra Brunbrel Brewery", "88 Hunlan Road, Zofield, WB 11118", "S3-2", "Mordra Brunbrel Brewery", None, 1.0, 1),
    ("S1-3", "Mordra Brunbrel Brewery", "88 Hunlan Road, Zofield, WB 11118", "S3-2", "Mordra Brunbrel Brewery", None, 1.0, 1),
]


def pairs(df):
    return {(r[0], r[1]) for r in df.collect()}


def test_same_organisation(spark):
    got = pairs(variants.same_organisation(live(spark, ROWS), Stage(spark, "t")))
    breweries = {"S1-1": "a", "S2-1": "b", "S2-2": "c", "S1-3": "d", "S3-2": "d"}
    assert got == {tuple(sorted((x, y))) for x in breweries for y in breweries if x != y and breweries[x] != breweries[y]}
    assert variants.same_organisation(live(spark, []), Stage(spark, "t")).count() == 0


def test_line_less_spelling_with_a_slip_in_the_middle(spark):
    """Ten letters with one slip in the middle have no run of six letters in common."""
    got = pairs(variants.same_organisation(live(spark, [("S1-1", "Danhujispro Ltd", "1 A Road", "S2-1", "Danhukispro Bakery", "1 A Road", 1.0, 1), ("S1-2", "Mordra Brunbrel Bakery", "2 B Road", "S2-2", "Gorfuwel Plumbing", "2 B Road", 1.0, 1)]), Stage(spark, "t")))
    assert got == {("S1-1", "S2-1")}


def test_same_location(spark):
    got = pairs(addresses.same_location(live(spark, ROWS), Stage(spark, "t")))
    # the record without a unit stands with both units, which contradict each other
    assert got == {("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S2-1", "S2-2"), ("S1-2", "S2-2")}
    assert addresses.same_location(live(spark, []), Stage(spark, "t")).count() == 0


def test_place_pairs_against_all_pairs(spark):
    """The keyed joins find what the rules say of all pairs of a small set."""
    ship(spark)
    rng = random.Random(8)
    streets, cities = ["Gorfuwel", "Gorfuwle", "Hupristror", "Zan"], ["Lorliville", "Lorlivile", ""]
    texts = set()
    for _ in range(120):
        unit = rng.choice(["", "Suite 3, ", "Suite 4, "])
        texts.add(f"{unit}{rng.choice([12, 13])} {rng.choice(streets)}{rng.choice([' Court', ' Ct', ''])}, {rng.choice(cities)}, WB{rng.choice([' 32218', ' 32219', ''])}")
    places = addresses.locations(spark.createDataFrame([(t,) for t in texts], "addr string"), Stage(spark, "t"))
    rows = {r.place: r for r in places.collect()}
    agree = lambda a, b: a == b or not a or not b

    def close(a, b, more=0):
        short = min(len(a), len(b))
        d = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            e = [i]
            for j, y in enumerate(b, 1):
                e.append(min(d[j] + 1, e[-1] + 1, d[j - 1] + (x != y)))
            d = e
        return d[-1] <= (3 + more if short >= 10 else 2 + more if short >= 6 else 1 if short >= 4 else 0)

    def same(a, b):
        if a.number != b.number or not agree(a.unit, b.unit) or not agree(a.kind, b.kind) or not agree(a.direction, b.direction):
            return False
        street = a.street == b.street or close(a.street, b.street)
        if a.postal and b.postal:
            return a.postal == b.postal and (a.street == b.street or close(a.street, b.street, 1))
        if a.street == b.street:
            return a.city == b.city or close(a.city, b.city) or (not a.city or not b.city) and a.region == b.region != ""
        return street and a.city == b.city != ""

    expected = {tuple(sorted((p, q))) for p in rows for q in rows if p < q and same(rows[p], rows[q])}
    assert {tuple(r) for r in addresses.same_place_pairs(places).collect()} == expected


@pytest.mark.parametrize("text", [None, "", " ", "N/A", "-", "unknown", "n.a.", "near Old Mill"])
def test_no_address(text):
    assert addresses.parse_address(text) is None


@pytest.mark.parametrize(
    ("a", "b"),
    [
        ("24/1987 Gorfuwel Court, Saint Hissufield, YC 49258", "1987 Gorfuwel Ct, Suite 24, St Hissufield, YC 49258, USA"), ("Zodorisstraße 181, 25876 Hitoburg", "25876 Hitoburg, Zodorisstr. 181, Deutschland"),
        ("#50, 357 North Prekifi Avenue, Makafield, QA 10157", "357 N. Prekifi Ave; Suite 50; Makafield; QA 10157"), ("97, AV Tenosor, Bât. D, 17120 Larelvl.", "97 avenue Tenosor, bat D, près de la gare, 17120 Larelville"),
        ("ul. Truhikun 101, of. 15, 1068 Sveti Ranvisovo", "str. Truhikun 101, ofis 15, 1068 Sveti Ranvisovo"),
    ],
)
def test_same_components(a, b):
    assert addresses.parse_address(a) == addresses.parse_address(b)


def test_same_establishment(spark):
    known = spark.createDataFrame([("S1-1", "S2-1,S2-2"), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string")
    got = establishments.same_establishment(live(spark, ROWS), known, Stage(spark, "t")).collect()
    found = {(r.s1_id, r.cand_id): r for r in got}
    assert {("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-3", "S3-2")} <= set(found)
    assert not any(s == "S1-2" for s, _ in found)
    assert all(0 < r.confidence < 1 for r in got)
    assert establishments.same_establishment(live(spark, []), known.limit(0), Stage(spark, "t")).count() == 0


def test_repeated_records_go_through_the_rules_once(spark, monkeypatch):
    """Thirty records a side with one name and place, and a candidate without an address: all pairs come out, two profiles go in."""
    rows = [(f"S1-{i}", "Mordra Brunbrel Brewery Ltd", "12 Gorfuwel Court, Lorliville, WB 32218", f"S2-{i}", "Mordra Brunbrel, Brewery", "12 Gorfuwel Ct, Lorliville, WB 32218", 1.0, 1) for i in range(30)]
    rows.append(("S1-0", None, None, "S3-1", "Mordra Brunbrel Brewery", "N/A", 1.0, 1))
    given, real = [], establishments.cascade
    monkeypatch.setattr(establishments, "cascade", lambda s1, cand, stage: given.append((s1.count(), cand.count())) or real(s1, cand, stage))
    known = spark.createDataFrame([("S1-1", "S2-1")], "source1_entity_id string, matched_entity_ids string")
    got = establishments.same_establishment(live(spark, rows), known, Stage(spark, "t")).collect()
    assert given == [(1, 2)]
    assert sorted((r.s1_id, r.cand_id, r.rule) for r in got) == sorted([(f"S1-{i}", f"S2-{j}", 0) for i in range(30) for j in range(30)] + [(f"S1-{i}", "S3-1", 6) for i in range(30)])
    assert {r.rule: round(r.confidence, 6) for r in got} == {0: round(2 / 32, 6), 6: round(1 / 3, 6)}
