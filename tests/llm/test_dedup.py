import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidegrid.llm import components, exact_dedup, line_dedup, minhash

SCHEMA = "doc_id long, text string"


def test_exact_groups_odd_rows(spark, odd):
    got = {(r["doc_id"], r["text_sha256"]): r for r in exact_dedup.groups(odd).collect()}
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    same = digest("Alpha beta gamma delta.")
    assert got[(1, same)]["keep_id"] == 1 and got[(1, same)]["group_size"] == 4 and got[(1, same)]["kept"]
    assert not got[(10, same)]["kept"] and got[(10, same)]["keep_id"] == 1
    assert got[(3, digest(""))]["keep_id"] == 3 and got[(4, digest(""))]["keep_id"] == 3
    assert got[(5, digest(" "))]["group_size"] == 1
    assert got[(None, digest("alpha"))]["kept"]
    assert exact_dedup.groups(odd).count() == odd.count()


def test_exact_first_of_each_keeps_columns(odd, empty):
    kept = exact_dedup.first_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 3, 5, 6, 7, 8, 9]
    assert exact_dedup.first_of_each(empty).count() == 0 and exact_dedup.groups(empty).count() == 0


def test_exact_digest_of_several_texts(spark, odd, monkeypatch):
    """Texts decide where digests clash: with a digest that all share the groups are the same."""
    expected = sorted((r["doc_id"] or -1, r["keep_id"] or -1, r["group_size"]) for r in exact_dedup.groups(odd).collect())
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda column, bits: F.lit("clash"))
    assert sorted((r["doc_id"] or -1, r["keep_id"] or -1, r["group_size"]) for r in exact_dedup.groups(odd).collect()) == expected


def near_rows(rng, n=120):
    words = [f"w{i}" for i in range(60)]
    rows = []
    for g in range(n // 8):
        base = [rng.choice(words) for _ in range(rng.randint(20, 90))]
        for _ in range(8):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append(" ".join(own))
    rng.shuffle(rows)
    return [(i, x.upper() if i % 5 == 0 else x) for i, x in enumerate(rows)]


def brute(rows, width, percent):
    sets = {}
    for i, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").lower())
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("width", "percent", "bands", "rows"), [(3, 85, 28, 6), (5, 80, 32, 5)])
def test_minhash_equals_brute_force(spark, width, percent, bands, rows):
    data = near_rows(random.Random(width))
    got = minhash.near_groups(spark.createDataFrame(data, SCHEMA), width, percent, bands, rows).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(data, width, percent)


@pytest.mark.parametrize(("width", "percent", "bands", "rows", "common"), [(3, 85, 28, 6, 7), (5, 80, 32, 5, 5)])
def test_minhash_short_texts_just_similar_enough(spark, width, percent, bands, rows, common):
    """Pairs of 4 to 20 shingles, of which one text has all and the other just enough, and nothing else is alike."""
    rng = random.Random(21)
    data, expected = [], {}
    for i in range(0, 6000, 2):
        n = common if i % 4 else rng.randint(4, 20)
        fewer = -(-percent * n // 100)
        words = [f"{rng.getrandbits(48):x}" for _ in range(n + width - 1)]
        data += [(i, " ".join(words)), (i + 1, " ".join(words[: fewer + width - 1]))]
        expected |= {i: (n, i), i + 1: (fewer, i)}
    assert brute(data[:200], width, percent) == {i: expected[i] for i in range(200)}
    got = minhash.near_groups(spark.createDataFrame(data, SCHEMA), width, percent, bands, rows).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected


def family(rng, n, shingles, width, edits):
    """Texts made from one by replacing single words, so that pairs lie on either side of the threshold."""
    base = [f"{rng.getrandbits(40):x}" for _ in range(shingles + width - 1)]
    out = []
    for _ in range(n):
        own = list(base)
        for at in rng.sample(range(len(own)), rng.choice(edits)):
            own[at] = f"{rng.getrandbits(40):x}" if rng.random() < 0.7 else f"w{at}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("small", [2, 64])
def test_minhash_families_on_both_sides_of_the_threshold(spark, small):
    """Large buckets of texts just below the threshold, by differences from a centre, equal brute force."""
    rng = random.Random(small)
    texts = family(rng, 160, 100, 3, [1, 2, 3, 3, 4]) + family(rng, 80, 60, 3, [1, 2, 2, 3]) + family(rng, 60, 30, 3, [1, 1, 2])
    rng.shuffle(texts)
    data = list(enumerate(texts))
    expected = brute(data, 3, 85)
    assert 20 < len({root for _, root in expected.values()}) < 280
    got = minhash.near_groups(spark.createDataFrame(data, SCHEMA), small=small).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected


def test_minhash_pairs_grow_with_members(spark, monkeypatch):
    """A family twice as large has about twice the rows of every table, not four times."""
    rng, rows, written = random.Random(31), [], minhash.session.written
    texts = family(rng, 800, 100, 3, [3, 4, 5])

    def counting(df, name):
        out = written(df, name)
        if name not in ("labels", "edges"):
            rows[-1][name] = max(rows[-1].get(name, 0), out.count())
        return out

    monkeypatch.setattr(minhash.session, "written", counting)
    for n in (400, 800):
        rows.append({})
        minhash.near_groups(spark.createDataFrame(list(enumerate(texts[:n])), SCHEMA))
    assert rows[1]["pairs"] <= 8 * 800 and all(v <= 2.8 * rows[0][k] + 200 for k, v in rows[1].items()), rows


def rows_of_joins(spark, keys, since=-1):
    """(rows that joins whose description matches ``keys`` made in executions after ``since``, the last execution)."""
    store = spark._jsparkSession.sharedState().statusStore()
    runs, made, last = store.executionsList(), 0, since
    for run in (runs.apply(i).executionId() for i in range(runs.size())):
        last = max(last, run)
        if run <= since:
            continue
        nodes, values = store.planGraph(run).allNodes(), store.executionMetrics(run)
        for node in (nodes.apply(i) for i in range(nodes.size())):
            if "Join" not in node.name() or not re.search(keys, node.desc()):
                continue
            for metric in (node.metrics().apply(i) for i in range(node.metrics().size())):
                if metric.name() == "number of output rows" and (value := values.get(metric.accumulatorId())).isDefined():
                    made += int(value.get().replace(",", ""))
    return made, last


def test_minhash_members_get_their_sketch_once(spark, monkeypatch):
    """Rows of buckets and of differing shingles are joined with sketches once, not for each side of a comparison."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for n, edits in ((40, 10), (12, 12)):
        base = [rng.choice(words) for _ in range(300)]
        for _ in range(n):
            own = list(base)
            for _ in range(edits):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts.append(" ".join(own))
    tables, written = {}, minhash.session.written

    def recorded(df, name):
        out = written(df, name)
        tables.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(minhash.session, "written", recorded)
    _, since = rows_of_joins(spark, "a^")
    minhash.near_groups(spark.createDataFrame(list(enumerate(texts)), SCHEMA), small=16)
    made, _ = rows_of_joins(spark, r"\[rep#\d+L\], \[rep#\d+L\], Inner", since)
    assert tables["differences"][0] > 100 and tables["mixed"][-1] > 100
    assert 0 < made <= tables["differences"][0] + tables["mixed"][-1] + tables["around"][0]


def test_minhash_members_get_their_component_once(spark, monkeypatch):
    """Components are joined with members, not with each of their differing shingles; these get them in one join."""
    rng = random.Random(7)
    texts = family(rng, 120, 100, 3, [3, 4, 5])
    tables, written = {}, minhash.session.written

    def recorded(df, name):
        out = written(df, name)
        tables.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(minhash.session, "written", recorded)
    _, since = rows_of_joins(spark, "a^")
    minhash.near_groups(spark.createDataFrame(list(enumerate(texts)), SCHEMA), small=16)
    by_center, _ = rows_of_joins(spark, r"\[center#\d+L\], \[center#\d+L\], LeftOuter", since)
    by_member, _ = rows_of_joins(spark, r"\[center#\d+L, rep#\d+L\], \[center#\d+L, rep#\d+L\], Inner", since)
    assert tables["differences"][0] > 2 * tables["around"][0] > 200
    assert 0 < by_center <= 2 * tables["around"][0]
    assert 0 < by_member <= tables["differences"][0]


def test_minhash_long_words_without_pattern_differ(spark):
    """Words in Thue-Morse order and their complements, whose sums agree under powers of one number, stay apart."""
    data = []
    for bits in (10, 11, 12):
        word = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << bits))
        data += [(bits, word), (bits + 100, word.translate(str.maketrans("ab", "ba")))]
    got = minhash.near_groups(spark.createDataFrame(data, SCHEMA)).collect()
    assert all(r["kept"] and r["n_shingles"] == 1 for r in got)


def test_minhash_odd_rows(odd, empty):
    got = minhash.near_groups(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r for r in got}
    assert by[3]["n_shingles"] == by[4]["n_shingles"] == by[5]["n_shingles"] == 0 and by[5]["kept"]
    assert by[6]["n_shingles"] == by[8]["n_shingles"] == 1 and by[10]["component_id"] == 1 and not by[2]["kept"]
    assert by[None]["component_id"] is None and by[None]["kept"]
    kept = minhash.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 1, 3, 4, 5, 6, 7, 8, 9]
    assert minhash.near_groups(empty).count() == 0


def test_components_of_paths_and_stars(spark):
    rows = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(31)) and all(got[i] == 100 for i in range(100, 140)) and 200 not in got


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, text, letters, n):
    out = list(text)
    for _ in range(n):
        i = rng.randrange(len(out) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            out.insert(i, rng.choice(letters))
        elif out and i < len(out):
            out[i : i + 1] = [] if kind == 1 else [rng.choice(letters)]
    return "".join(out)


def test_banded_distance_and_segments():
    rng = random.Random(4)
    for _ in range(4000):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 24)))
        b = edited(rng, a, "abé", rng.randint(0, 5))
        for most in (1, 2, 3):
            true = distance(a, b)
            assert line_dedup.within(a, b, most) == (true if true <= most else None)
            if true <= most < min(len(a), len(b)):
                x, y = sorted((a, b), key=len)
                index = {(len(x), i, x[s : s + z]) for i, (s, z) in enumerate(line_dedup.segments(len(x), most))}
                assert index & {(n, i, y[s : s + z]) for n, i, s, z in line_dedup.probes(len(y), most)}


def classes_by_brute_force(docs, edits=2):
    """{place: smallest place of its class}, {place: smallest place of its equals}, {pair of smallest places: distance}."""
    at = {(d, n): x for d, text in docs for n, x in enumerate((text or "").split("\n")) if re.sub("[\x20\x09-\x0d]", "", x)}
    first = {}
    for place in sorted(at):
        first.setdefault(at[place], place)
    root = {p: p for p in first.values()}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    links = {}
    for x, p in first.items():
        for y, q in first.items():
            if p < q and abs(len(x) - len(y)) <= edits and (d := distance(x, y)) <= edits:
                links[p, q] = d
                low, high = sorted((find(p), find(q)))
                root[high] = low
    return {p: find(first[x]) for p, x in at.items()}, {p: first[x] for p, x in at.items()}, links


def same_as_brute_force(rows, docs):
    classes, equals, links = classes_by_brute_force(docs)
    members = [r for r in rows if r["relation"] == "member"]
    assert len(members) == len(classes)
    assert {(r["doc_id"], r["line_no"]): (r["class_doc"], r["class_line"]) for r in members} == classes
    assert {(r["doc_id"], r["line_no"]): (r["to_doc"], r["to_line"]) for r in members} == equals
    found = {((r["doc_id"], r["line_no"]), (r["to_doc"], r["to_line"])): r["distance"] for r in rows if r["relation"] == "link"}
    assert found.items() <= links.items()
    # the links that are listed connect every class
    root = {p: p for p in equals.values()}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for p, q in found:
        low, high = sorted((find(p), find(q)))
        root[high] = low
    assert all(find(p) == classes[p] for p in root)
    return found, links


@pytest.mark.parametrize(("small", "levels"), [(1024, 2), (2, 3)])
def test_line_classes_equal_brute_force(spark, monkeypatch, small, levels):
    """Families of lines, on either side of two edits, in keys that are crossed at once or cut again."""
    rng = random.Random(9 + levels)
    lines = []
    for _ in range(40):
        base = "".join(rng.choice("abcdef ") for _ in range(rng.randint(6, 30))) + "z"
        lines += [base] + [edited(rng, base, "abcdef", rng.randint(0, 3)) for _ in range(3)]
    long = "".join(rng.choice("abcdefgh ") for _ in range(70))
    lines += [edited(rng, long, "abcdefghé", rng.choice([1, 2, 2, 3, 3, 4])) for _ in range(120)]
    docs = [(i, "\n".join(lines[i * 8 : i * 8 + 8])) for i in range(len(lines) // 8)]
    links_of = line_dedup.links_of
    monkeypatch.setattr(line_dedup, "links_of", lambda classes, edits: links_of(classes, edits, small, levels))
    same_as_brute_force(line_dedup.related(spark.createDataFrame(docs, SCHEMA)).collect(), docs)


def test_line_query_links_short_lines(spark, tmp_path):
    """Classes of lines of 1 to 12 characters, one place for each, are those of brute force."""
    rng = random.Random(12)
    lines = ["And ornd.", "And | ornd.", "Is with.", "Is | with.", "a", "é", "ab", "abc", "abcd", "abcde", "abcdefghi", "abcdefghj"]
    lines += ["".join(rng.choice("abcdé ") for _ in range(rng.randint(5, 11))) + "z" for _ in range(40)]
    lines += ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(1, 11))) for _ in range(150)]
    lines = [x for x in dict.fromkeys(lines) if x.strip()]
    docs = list(enumerate(lines))
    spark.createDataFrame(docs, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    same_as_brute_force(line_dedup.query(spark, str(tmp_path)).collect(), docs)


def test_line_family_takes_rows_in_proportion(spark):
    """Lines one letter away from a template: pairs grow with the square, the result doesn't."""
    rng = random.Random(15)
    base = "".join(rng.choice("abcdefgh ") for _ in range(48))
    lines = [base[:i] + "XYZ"[k] + base[i + 1 :] for i in range(48) for k in range(3)]
    docs = list(enumerate(lines))
    found, links = same_as_brute_force(line_dedup.related(spark.createDataFrame(docs, SCHEMA)).collect(), docs)
    assert len(links) > 50 * len(lines) and len(found) <= 4 * len(lines)


@pytest.mark.parametrize(("small", "levels"), [(1024, 2), (2, 3), (3, 2), (4, 1)])
def test_line_links_are_all_counted(spark, monkeypatch, small, levels):
    """Each line has as many links as brute force finds between different lines, those within a class included."""
    rng = random.Random(31 + levels)
    long = "".join(rng.choice("abcdefgh ") for _ in range(60))
    lines = [edited(rng, long, "abcdefghé", rng.choice([1, 1, 2, 3])) for _ in range(90)]
    lines += ["ab" * 12 + "ab"[: n % 3] + "c" * (n % 5) for n in range(30)] + ["a" * n for n in range(1, 14)]
    lines += ["".join(rng.choice("abé") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    docs = [(i, "\n".join(lines[i * 7 : i * 7 + 7])) for i in range(-(-len(lines) // 7))]
    links_of = line_dedup.links_of
    monkeypatch.setattr(line_dedup, "links_of", lambda classes, edits: links_of(classes, edits, small, levels))
    rows = line_dedup.related(spark.createDataFrame(docs, SCHEMA)).collect()
    _, links = same_as_brute_force(rows, docs)
    true = Counter(p for pair in links for p in pair)
    assert len(links) > 1000
    assert all(r["n_links"] == true[r["to_doc"], r["to_line"]] for r in rows if r["relation"] == "member")


def test_lines_of_separators_are_lines(spark):
    """Only ASCII white space is blank: a line of U+2028, U+2029 or U+0085 alone, or after blanks, is a line like others."""
    docs = [(0, "\u2028\n \u2029\n\t\u0085\n \r\n\n")]
    rows = line_dedup.related(spark.createDataFrame(docs, SCHEMA)).collect()
    same_as_brute_force(rows, docs)
    assert sorted(r["line_no"] for r in rows if r["relation"] == "member") == [0, 1, 2]


def test_lines_cleaned(spark, odd, empty):
    rows = [(1, "a line of some length\n\nshort\nshort", 1), (2, "a line of sume length\nshort\nnew line that stays", 2), (3, None, 3)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.cleaned(spark.createDataFrame(rows, SCHEMA + ", _drop int")).collect()}
    assert got == {1: "a line of some length\n\nshort", 2: "new line that stays", 3: None}
    assert line_dedup.related(empty).count() == 0
    assert line_dedup.related(odd).filter("relation = 'member'").count() == 9
