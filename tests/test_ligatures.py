"""The steps of ligature repair after the first one, against a plain form of the same rules."""

import re

from rillflow.operators import words

LISTED = {"section": 10, "attention": 10, "time": 10, "frames": 20, "impact": 20, "soft": 10, "micro": 40, "narrative": 35, "written": 10, "attempt": 20, "rarely": 70, "tattoo": 70, "butter": 60, "letter": 10, "the": 10, "matter": 10}
LOST = "�"


def tier(w):
    w = w.lower()
    return LISTED.get(w, LISTED.get(w[:-1], 99) if w.endswith("s") else 99)


def doubled(w):
    return [w[:i] + "t" + w[i:] for i, c in enumerate(w) if c == "t"]


def best(ws, most=98):
    ws = [w for w in ws if tier(w) <= most]
    return min(ws, key=tier) if ws else None


def compound(w):
    m = re.match(r"^(.{4,}?)(ly|ful|ness|less)$", w, re.I)
    return bool(m and tier(m[1]) <= 60) or any(tier(w[:i]) <= 60 and tier(w[i:]) <= 60 for i in range(3, len(w) - 2))


def plain(word):
    if LOST in word and any(c.isalpha() for c in word):
        filled = [""]
        first, *rest = word.split(LOST)
        if len(rest) > 3:
            return word
        filled = [first]
        for r in rest:
            filled = [f + x + r for f in filled for x in words.LIGATURES]
        return best(filled) or best([d for f in filled for d in doubled(f)]) or next((f for f in filled if compound(f)), word)
    if re.fullmatch("[A-Za-z]+", word) and len(word) > 4 and tier(word) == 99:
        return best(doubled(word), 60) or word
    return word


def test_all_steps(spark):
    d = spark.createDataFrame(list(LISTED.items()), "word string, tier int")
    texts = [
        "sec�on aten�on �meframes impac�ul narra�vely Microso�",
        "� writen atempt Writen tatoo leters mater but Zorba �zq",
        "writen atempt, no sign",
        "�wri�en sec����on leter �e sec�ons le�ers buter",
        None,
        "",
    ]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: (r.text, r.marked, r.doubled) for r in words.repaired(rows, d, "id", "text").collect()}
    for i, t in enumerate(texts):
        if not t or LOST not in t:
            assert got[i] == (t, 0, 0)
            continue
        each = re.findall(rf"[^\W\d_{LOST}]*(?:{LOST}[^\W\d_{LOST}]*)+|[^\W\d_]+", t)
        fixed = [plain(w) for w in each]
        changed = [LOST in w for w, f in zip(each, fixed) if w != f]
        at = iter(fixed)
        text = re.sub(rf"[^\W\d_{LOST}]*(?:{LOST}[^\W\d_{LOST}]*)+|[^\W\d_]+", lambda m: next(at), t)
        assert got[i] == (text, sum(changed), len(changed) - sum(changed))
    assert got[0][0] == "section attention timeframes impactful narratively Microsoft" and got[0][1:] == (6, 0)
    assert "written attempt Written tatoo letters matter" in got[1][0] and got[1][2] == 5


def test_words_are_put_back_a_batch_at_a_time(spark):
    """No lookup in a map for each word, which took the square of a text's words; gaps, null and unhurt texts stay."""
    d = spark.createDataFrame(list(LISTED.items()), "word string, tier int")
    texts = {1: "\n sec�on, \tatempt-sec�on �", 2: None, 3: "atempt sec-on", 4: "�?", 5: "sec�on" * 1 + " me�?" * 3 + " sec�on", 6: "12 � 34 �me's\u00bd�me "}
    out = words.repaired(spark.createDataFrame(list(texts.items()), "id int, text string"), d, "id", "text")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1 and "element_at" not in plan and "map_contains_key" not in plan
    assert {r.id: (r.text, r.marked, r.doubled) for r in out.collect()} == {
        1: ("\n section, \tattempt-section �", 2, 1), 2: (None, 0, 0), 3: ("atempt sec-on", 0, 0), 4: ("�?", 0, 0),
        5: ("section" + " me�?" * 3 + " section", 2, 0), 6: ("12 � 34 time's½time ", 2, 0),
    }


def test_forms_of_the_dictionary(spark):
    d = spark.createDataFrame([("time", 10), ("times", 40), ("bus", 20)], "word string, tier int")
    w = spark.createDataFrame([(x,) for x in ("Times", "TIME", "buss", "bus", "bu", "none")], "word string")
    assert {r.word: r.tier for r in words.tier_of(w, d).collect()} == {"Times": 40, "TIME": 10, "buss": 20, "bus": 20, "bu": None, "none": None}
    assert words.tier_of(w, d)._jdf.queryExecution().executedPlan().toString().count("Join") == 1
