import re

from ledgertag.llm import licenses

SCHEMA = "doc_id long, text string, matches int"


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def bigrams(w):
    return {tuple(w[i : i + 2]) for i in range(len(w) - 1)}


def best(text, template):
    """The best coefficient of any passage, by looking at all of them."""
    w, t = words(text), words(template)
    b = bigrams(t)
    top = 0.0
    for i in range(len(w)):
        for j in range(i + 2, len(w) + 1):
            a = bigrams(w[i:j])
            top = max(top, 2 * len(a & b) / (len(a) + len(b)))
    return top


TEMPLATES = {"A": licenses.TEMPLATES["Apache-2.0 notice"], "M": licenses.TEMPLATES["MPL-2.0"], "one": "word"}
TEXTS = {
    1: "foo bar. Licensed under the Apache License, Version 2.0. And on",
    2: None,
    3: "",
    4: "licensed under the apache licence version 2 0",
    5: "Licensed under the MIT License",
    6: "so " * 30 + TEMPLATES["M"].replace("Mozilla ", "").upper() + " la" * 20,
    9: "x " + " ".join(TEMPLATES["M"].split()[:18]) + " go on with the software and on and on",
    10: " ".join([*TEMPLATES["M"].split()[:15], *(f"w{i}" for i in range(9)), *TEMPLATES["M"].split()[15:]]),
    7: TEMPLATES["A"] + " and " + TEMPLATES["A"],
    8: "the " * 30_000 + TEMPLATES["A"],
}


def test_passages_against_brute_force(spark):
    frame = spark.createDataFrame([(i, t, 1) for i, t in TEXTS.items()], SCHEMA).repartition(2)
    found = {r.doc_id: r.matches for r in licenses.scan(frame, TEMPLATES).collect()}
    for i, text in TEXTS.items():
        names = {m.license for m in found[i]}
        if i != 8:
            for name in ("A", "M"):
                top = best(text, TEMPLATES[name])
                assert (name in names) == (top >= licenses.DICE), (i, name, top)
        for m in found[i]:
            passage = bigrams(words(text)[m.first_word : m.first_word + m.n_words])
            own = bigrams(words(TEMPLATES[m.license]))
            assert abs(m.dice - 2 * len(passage & own) / (len(passage) + len(own))) < 1e-9
    assert len(found[7]) == 2 and found[8][0].first_word == 30_000


def test_summary_and_empty_table(spark):
    frame = spark.createDataFrame([(1, TEXTS[1], 1), (2, None, 1), (2, None, 1)], SCHEMA)
    rows = sorted(tuple(r) for r in licenses.summary(licenses.scan(frame)).select("doc_id", "n_matches", "licenses").collect())
    assert rows == [(1, 1, "Apache-2.0 notice"), (2, 0, ""), (2, 0, "")]
    assert licenses.scan(spark.createDataFrame([], SCHEMA)).count() == 0


def test_creative_commons_and_proprietary_lines(spark):
    lines = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0 short",
        "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0 short",
        "All rights reserved.": "Proprietary notice",
        licenses.TEMPLATES["CC-BY-NC-SA-4.0 notice"]: "CC-BY-NC-SA-4.0 notice",
    }
    frame = spark.createDataFrame([(i, f"Some prose. {t} More prose.", 1) for i, t in enumerate(lines)], SCHEMA)
    found = {r.doc_id: r.best_license for r in licenses.summary(licenses.scan(frame)).collect()}
    assert found == dict(enumerate(lines.values()))


def names_in(spark, texts):
    frame = spark.createDataFrame([(i, f"Some prose. {t} More prose.", 1) for i, t in enumerate(texts)], SCHEMA)
    found = licenses.summary(licenses.scan(frame)).select("doc_id", "licenses", "n_matches").collect()
    return [(r.licenses, r.n_matches) for r in sorted(found)]


def test_every_template_names_itself_and_nothing_else(spark):
    assert len(licenses.TEMPLATES) >= 40
    names = list(licenses.TEMPLATES)
    assert names_in(spark, licenses.TEMPLATES.values()) == [(name, 1) for name in names]


def test_versions_and_variants_without_a_template_are_not_named(spark):
    texts = [
        "Licensed under the Apache License, Version 1.0.", "Licensed under CC BY-NC 1.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 1.0 Generic License.",
        "This work is licensed under the GNU General Public License, version 1.",
        "This work is licensed under the GNU Library General Public License, version 2.",
        "Licensed under the Eclipse Public License, Version 3.0.",
    ]
    assert names_in(spark, texts) == [("", 0)] * len(texts)


def test_altered_long_texts_are_found(spark):
    mit = licenses.TEMPLATES["MIT"].split()
    inserted = [*mit[:80], *(f"foreign{i}" for i in range(57)), *mit[80:]]
    cut = [*mit[: int(0.72 * len(mit))], *"and then the software went on to the next of the things".split()]
    twice = [*mit, *(f"foreign{i}" for i in range(9)), *mit]
    assert names_in(spark, [" ".join(x) for x in (inserted, cut, twice)]) == [("MIT", 1), ("MIT", 1), ("MIT", 2)]


def test_words_that_come_again_and_again(spark):
    texts = ["of the License " * 30_000, "the " * 30_000 + licenses.TEMPLATES["MIT notice"] + " the" * 30_000]
    assert names_in(spark, texts) == [("", 0), ("MIT notice", 1)]


def test_overlapping_passages():
    def match(license, first, n, dice):
        return {"license": license, "first_word": first, "n_words": n, "dice": dice}

    a, b, c, d = match("a", 0, 10, 0.9), match("b", 5, 10, 0.95), match("c", 15, 5, 0.8), match("d", 5, 10, 0.95)
    assert licenses.best_of_overlapping([a, b, c, d]) == [b, c]
    assert licenses.best_of_overlapping([a, c]) == [a, c] and licenses.best_of_overlapping([]) == []
