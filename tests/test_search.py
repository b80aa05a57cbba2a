import random
import re
from fnmatch import fnmatchcase

import pytest
from pyspark.sql import functions as F

from askframe.functions.globs import matches, translate
from askframe.operators import search as searching
from askframe.operators.search import any_match, found_patterns, search

CASES = [
    ("a.b", ["a.b"], ["axb", "a.bc", "xa.b"]),
    ("a+", ["a+"], ["aa", "a"]),
    ("*.txt", [".txt", "x.txt", ".hidden.txt"], ["x.txt.gz", "txt"]),
    ("a*a", ["aa", "aba"], ["a", "ab"]),
    ("a*", ["a", "ab"], ["ba", "A"]),
    ("*b*", ["b", "abc"], ["ac"]),
    ("a*b*c", ["abc", "axbxc", "abbcc"], ["acb", "ab"]),
    ("*ab*ab", ["abab", "xabyab"], ["ab", "xab"]),
    ("1??", ["123", "1é漢"], ["12", "1234"]),
    ("[0-4]*", ["0", "3x"], ["5", "x0"]),
    ("[!0-4]*", ["5", "x0"], ["0", "3x"]),
    ("[^0-4]", ["5", "^"], ["0", "3"]),
    ("[]a]", ["]", "a"], ["[", "b"]),
    ("[!]a]", ["b"], ["]", "a"]),
    ("[a-]", ["a", "-"], ["b"]),
    ("[z-a]", [], ["z", "a", "-", "m"]),
    ("[!z-a]", ["z", "q"], ["zz"]),
    ("[[:digit:]_]x", ["7x", "_x"], ["ax", ":x"]),
    ("[[:nosuch:]]", [], ["n", ":"]),
    ("[&&a]", ["&", "a"], ["b"]),
    ("[[a]", ["[", "a"], ["b"]),
    ("[abc", ["[abc"], ["a", "b"]),
    ("[!]", ["[!]"], ["a", "!", "]"]),
    ("x[^]*", ["x[^]", "x[^]y"], ["xa", "x^"]),
    ("[]", ["[]"], ["", "a"]),
    ("[!]x]", ["!", "a"], ["]", "x"]),
    ("[[:alpha:]]", ["é", "漢", "a"], ["1", "_"]),
    ("[[:punct:]]?", [".😀", "+a"], ["ab", "😀"]),
    ("[[:upper:][:digit:]]", ["É", "7"], ["é", "²"]),
    ("{a,b}", ["{a,b}"], ["a", "b"]),
    ("a\\*b", ["a*b"], ["axb", "a\\*b"]),
    ("[\\]]", ["]"], ["\\", "\\]"]),
    ("a\\", [], ["a", "a\\"]),
    ("", [], ["a"]),
    ("*", ["a", ".hidden"], []),
    ("a\nb*", ["a\nb", "a\nb\nc"], ["a\n"]),
    ("?", ["\n", "a"], ["ab"]),
    ("a", ["a"], ["a\n"]),
    ("$(x)|^y", ["$(x)|^y"], ["y"]),
]


@pytest.mark.parametrize("pattern, yes, no", CASES)
def test_pattern(spark, pattern, yes, no):
    names = spark.createDataFrame([(n,) for n in yes + no], "name string")
    test = names.select("name", matches(F.col("name"), pattern).alias("hit"), F.col("name").rlike(translate(pattern).regex).alias("regex"))
    for row in test.collect():
        assert row.hit == (row.name in yes), row.name
        assert row.regex == (row.name in yes), row.name


def test_inner_stars_do_not_backtrack(spark):
    names = spark.createDataFrame([("a" * 5000,)], "name string")
    assert not any_match(names, "*a*a*a*a*a*a*a*a*a*a*a*a*b")


def test_any_match(spark):
    names = spark.createDataFrame([("x.html",), (None,)], "name string")
    assert any_match(names, "*.html") and any_match(names, "*") and not any_match(names, "*.txt")


def random_table(rng, count):
    def text(alphabet, most):
        return "".join(rng.choice(alphabet) for _ in range(rng.randint(1, most)))

    names = sorted({text("abc01.", 7) for _ in range(count)})
    pieces = ["a", "b", "c", "0", "1", ".", "ab", "01", "*", "?", "[ab]", "[!ab]", "[0-1]", "*"]
    patterns = sorted({text(pieces, 5) for _ in range(count)})
    return names, patterns


def brute_force(names, patterns):
    return {p for p in patterns if any(fnmatchcase(n, p) for n in names)}


@pytest.mark.parametrize("seed, count", [(1, 20), (2, 150), (3, 150)])
def test_random_patterns(spark, seed, count):
    names, patterns = random_table(random.Random(seed), count)
    assert (len(patterns) <= searching.ONE_SCAN) == (count == 20)
    # A third of all rows on each side are one and the same.
    name_table = spark.createDataFrame([(n,) for n in names + [names[0]] * (len(names) // 2)], "name string")
    requests = spark.createDataFrame([(p,) for p in patterns + [patterns[0]] * (len(patterns) // 2)], "pattern string")
    found = [row.pattern for row in found_patterns(requests, name_table).collect()]
    assert sorted(found) == sorted(brute_force(names, patterns))
    answers = search(requests, name_table).collect()
    assert len(answers) == requests.count()
    assert {row.pattern for row in answers if row.found} == set(found)


def test_join_without_broadcast(spark, nothing_fits):
    names, patterns = random_table(random.Random(4), 120)
    name_table = spark.createDataFrame([(n,) for n in names * 2], "name string")
    requests = spark.createDataFrame([(p,) for p in patterns + [None] + [patterns[0]] * 50], "pattern string")
    answers = search(requests, name_table).collect()
    assert len(answers) == len(patterns) + 51
    assert {row.pattern for row in answers if row.found} == brute_force(names, patterns)
    assert [row.status for row in answers if row.pattern is None] == ["no_request"]


def test_one_scan_and_join_agree_on_the_cases(spark, monkeypatch):
    names = spark.createDataFrame([(n,) for _, yes, no in CASES for n in yes + no], "name string")
    requests = spark.createDataFrame([(p,) for p, _, _ in CASES], "pattern string")
    one_scan = {row.pattern for row in found_patterns(requests, names).collect()}
    monkeypatch.setattr(searching, "ONE_SCAN", 3)
    joined = {row.pattern for row in found_patterns(requests, names).collect()}
    assert one_scan == joined


def test_names_with_marks(spark, monkeypatch):
    monkeypatch.setattr(searching, "ONE_SCAN", 1)
    names = spark.createDataFrame([("x\x02ab\x03y",), ("cd",)], "name string")
    requests = spark.createDataFrame([("ab",), ("ab*",), ("*ab",), ("*ab*",), ("*\x02a*",), ("cd",)], "pattern string")
    assert sorted(row.pattern for row in found_patterns(requests, names).collect()) == ["*\x02a*", "*ab*", "cd"]


def test_anchors():
    assert translate("readme").anchors == ["\x02readme\x03"]
    assert translate("a*.html").anchors == ["\x02a", ".html\x03"]
    assert translate("x?*middle*[0-9]").anchors == ["\x02x", "ddle", "iddl", "midd"]
    assert translate("*x?").anchors == ["x"]
    assert translate("*\x02*").anchors == []
    assert translate("[0-4]??*").anchors == translate("*").anchors == translate("").anchors == []


def test_patterns_without_text():
    glob = translate("[0-4b]??*")
    assert glob.either == [f"\x02{c}" for c in "01234b"] and (glob.least, glob.has_star, glob.only_length) == (3, True, False)
    assert translate("*[xy]").either == ["x\x03", "y\x03"]
    assert translate("[!ab]*").either == translate("[[:alpha:]]*").either == translate("?[ab]?").either == []
    assert translate("??*").only_length and translate("*").least == 0 and not translate("?[a]").only_length
    assert translate("[ -~]*").either == []  # too large to list


def many_loose(count):
    """Distinct patterns without text: sets of every kind at every place."""
    rng = random.Random(9)
    pieces = ["?", "*", "[ab]", "[!ab]", "[0-9]", "[^c]", "[[:alpha:]]", "[!0-9.]"]
    found = set()
    while len(found) < count:
        found.add("".join(rng.choice(pieces) for _ in range(rng.randint(1, 7))))
    return sorted(found)


@pytest.mark.parametrize("fits", [True, False])
def test_loose_patterns_in_one_plan(spark, fits, request):
    if not fits:
        request.getfixturevalue("nothing_fits")
    names = sorted({"".join(random.Random(i).choice("abc01.") for _ in range(i % 6 + 1)) for i in range(90)})
    # One ending holds a third of the names.
    names += [f"{i}.hot" for i in range(45)]
    table = spark.createDataFrame([(n,) for n in names], "name string")
    patterns = many_loose(400) + ["*.hot", "[0-4]*.hot"]
    requests = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    found = found_patterns(requests, table)
    expected = {p for p in patterns if any(re.fullmatch(by_re(p), n, re.DOTALL) for n in names)}
    assert sorted(r.pattern for r in found.collect()) == sorted(expected)


def by_re(pattern):
    pattern = pattern.replace(".", "\\.") if "[" not in pattern else pattern.replace(".hot", "\\.hot")
    return pattern.replace("[[:alpha:]]", "[a-zA-Z]").replace("[!", "[^").replace("?", ".").replace("*", ".*")


def test_plan_does_not_grow_with_the_patterns(spark, tmp_path):
    path = str(tmp_path / "names")
    spark.createDataFrame([("a1",), ("b.c",)], "name string").write.parquet(path)
    scans = []
    for count in (100, 1000):
        requests = spark.createDataFrame([(p,) for p in many_loose(count)], "pattern string")
        plan = found_patterns(requests, spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
        scans.append(plan.count("FileScan"))
    assert scans[0] == scans[1] <= 8


def test_answers(spark):
    names = spark.createDataFrame([("a.txt",)], "name string")
    requests = spark.createDataFrame([(1, "*.txt"), (2, "b"), (3, None), (4, "")], "request_id int, pattern string")
    rows = {row.request_id: row for row in search(requests, names).collect()}
    assert [rows[i].status for i in (1, 2, 3, 4)] == ["ok", "not_found", "no_request", "not_found"]
    assert rows[1].message == "Файл '*.txt' найден"
    assert rows[2].message == "Файл 'b' не найден"
    assert rows[3].message is None and rows[3].found is False


def test_names_that_are_missing(spark, monkeypatch):
    names = spark.createDataFrame([(None,), ("a.txt",)], "name string")
    requests = spark.createDataFrame([("*",), ("*.txt",), ("b",), ("?[!x]*t",)], "pattern string")
    for bound in (64, 1):
        monkeypatch.setattr(searching, "ONE_SCAN", bound)
        found = {row.pattern for row in found_patterns(requests, names).collect()}
        assert found == {"*", "*.txt", "?[!x]*t"}


def test_only_impossible_patterns(spark, monkeypatch):
    monkeypatch.setattr(searching, "ONE_SCAN", 1)
    names = spark.createDataFrame([("a",)], "name string")
    requests = spark.createDataFrame([("",), ("a\\",)], "pattern string")
    assert [row.found for row in search(requests, names).collect()] == [False, False]


def test_no_requests(spark):
    names = spark.createDataFrame([("a",)], "name string")
    requests = spark.createDataFrame([], "pattern string")
    assert search(requests, names).collect() == []


def test_selective_patterns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "names")
    spark.createDataFrame([("a",), ("b",)], "name string").write.parquet(path)
    requests = spark.createDataFrame([("a",), ("b*",)], "pattern string")
    hits = found_patterns(requests, spark.read.parquet(path))
    plan = hits._jdf.queryExecution().toString()
    assert "StringStartsWith(name,b)" in plan and "EqualTo(name,a)" in plan
    assert sorted(row.pattern for row in hits.collect()) == ["a", "b*"]


# Many patterns without text


def many_without_text(rng, n):
    items = ["?", "*", "[!a]", "[^b-d]", "[a-z]", "[[:digit:]]", "[[:alpha:]_]", "[ab]", "[!]x]", "[]a]", "[é漢-龥]", "[!😀]", "[[:upper:]]"]
    return {"".join(["[!q]", *(rng.choice(items) for _ in range(rng.randrange(6))), "[!w]"][rng.randrange(2) :]) for _ in range(n)}


@pytest.mark.parametrize("at_once", [10**6, 300])
def test_many_patterns_without_text(spark, monkeypatch, at_once):
    """Every pattern against every name, as the predicate for one pattern answers."""
    from askframe.operators import many_globs

    monkeypatch.setattr(many_globs, "PATTERNS_AT_ONCE", at_once)
    rng = random.Random(9)
    patterns = sorted(many_without_text(rng, 900))
    names = ["".join(rng.choices("abcxyzé漢😀09_]-.A\n", k=rng.randrange(1, 8))) for _ in range(60)] + [""]
    table = spark.createDataFrame([(n,) for n in names + names[:20] + [None]], "name string")
    found = {r.pattern for r in found_patterns(spark.createDataFrame([(p,) for p in patterns], "pattern string"), table).collect()}
    regexes = [(p, translate(p).regex) for p in patterns]
    expected = spark.createDataFrame([(p, r, n) for p, r in regexes for n in names], "pattern string, regex string, name string")
    assert found == {r.pattern for r in expected.where(F.expr("name rlike regex")).select("pattern").distinct().collect()}
    assert 100 < len(found) < len(patterns)


def test_work_per_name_does_not_grow_with_the_patterns():
    """A step for each character that differs from the name before; none per pattern."""
    from askframe.operators.many_globs import Globs

    letters = "abcdefghij"
    sets = [(f"[{letters[:i]}{letters[i + 1 :]}]", letters[:i] + letters[i + 1 :]) for i in range(10)]
    names = sorted(f"{i:06d}".translate(str.maketrans("0123456789", letters)) for i in range(0, 10**6, 499))
    steps = []
    for n in (10, 10_000):
        rng = random.Random(n)
        # The last set is one that no name has a character of: nothing is found, nothing leaves.
        patterns = [(str(i), [[rng.choice(sets)[0] for _ in range(5)] + ["[~]"]]) for i in range(n)]
        globs = Globs(patterns, [*sets, ("[~]", "")], letters)
        for name in names:
            globs.read(name)
        steps.append((len(globs.moves), len(globs.path), globs.take_found()))
    assert steps[0] == steps[1] == (10, 7, [])


def test_ten_thousand_patterns_on_names_of_one_length(spark):
    """Half of them match; no plan of it joins names with patterns."""
    digits = [(a, b) for a in range(10) for b in range(a, 10)]
    patterns = [f"?[{a}-{b}][!{x}]?[{c}-{d}]?" for a, b in digits for c, d in digits for x in range(4)]
    names = spark.range(20_000).select(F.lpad((F.col("id") * 37 % 1000).cast("string"), 6, "0").alias("name"))
    wanted = spark.createDataFrame([(p,) for p in patterns], "pattern string")
    found = found_patterns(wanted, names)
    own = {f"{i:06d}" for i in range(1000)}
    assert {r.pattern for r in found.collect()} == {p for p in patterns if any(map(re.compile(p.replace("?", ".").replace("[!", "[^")).fullmatch, own))}
    assert len(patterns) > 10_000
