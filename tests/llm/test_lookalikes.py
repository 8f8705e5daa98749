import random

from rastro.llm.lookalikes import canonical_texts, same_looking_pairs, shown

SCHEMA = "field_name string, record_id bigint, text string"


def pairs(spark, *texts):
    rows = [("f", i, t) for i, t in enumerate(texts)]
    return {(r.id_a, r.id_b) for r in same_looking_pairs(spark.createDataFrame(rows + rows, SCHEMA)).collect()}


def test_same_and_different(spark):
    base = "Jarra café rosa 20 Ω K 5 μm"
    same = ["Jarra café rosa 20 Ω K 5 μm", "Jarra café rosa 20 Ω K 5 μm", "Jаrra café rosa 20 Ω K 5 μm", "Jarra caf​é rοsа 20 Ω K 5 µm", "Ｊarra café ｒｏｓａ 20 Ω K 5 μm", "Ja­rra café rosa 20 Ω К 5 μm"]
    other = ["jarra café rosa 20 Ω K 5 μm", "Jarra cafe rosa 20 Ω K 5 μm", "Jarra café rosa ² 20 Ω K 5 μm", "Jarra café rosa 20 O K 5 um", "Jarra café rosa 20 Ω K 5 μm 👩‍🍳", "Jarra café rosa 20 Ω K 5 μm 👩🍳"]
    n = len(same)
    assert pairs(spark, base, *same, *other) == {(a, b) for a in range(n + 1) for b in range(a + 1, n + 1)}


def test_marks_that_are_seen_stay():
    for text in ("½ y 1/2", "① ª º ™ m²", "👩‍🍳"):
        assert shown(text) == text


def test_words_of_another_script_stay(spark):
    rows = canonical_texts(spark.createDataFrame([("f", 1, "Привет мир и слово"), ("f", 2, "Приветы cлово"), ("f", 3, "5 μm 20 Ω"), ("f", 4, "casa слово")], SCHEMA)).collect()
    got = {r.record_id: r.canonical for r in rows}
    assert got[1] == "Привет мир и слово" and got[3] == "5 μm 20 Ω" and got[4] == "casa слово"
    assert got[2] == "Приветы слово"


def test_unknown_results_are_not_guessed(spark):
    got = canonical_texts(spark.createDataFrame([("f", 1, "zzаq solo aquí"), ("f", 2, "otro texto")], SCHEMA)).collect()
    assert {r.canonical for r in got if r.record_id == 1} == {"zzаq solo aquí"}


def test_two_repairs_support_each_other(spark):
    assert pairs(spark, "Lаpidabi uno", "Lapidаbi uno") == {(0, 1)}


def test_random_dirt_is_found(spark):
    rng = random.Random(3)
    words = ["cesto", "papel", "sarten", "cocina", "rosa", "jarra", "pan", "aceite"]
    swap = {"a": "а", "e": "е", "o": "о", "p": "р", "c": "с"}
    texts = []
    for i in range(40):
        clean = " ".join(rng.sample(words, 4)) + f" {i}"
        at = rng.choice([k for k, ch in enumerate(clean) if ch in swap])
        texts += [clean, clean[:at] + swap[clean[at]] + clean[at + 1 :]]
    assert pairs(spark, *texts) == {(2 * i, 2 * i + 1) for i in range(40)}


def test_edges(spark):
    assert pairs(spark) == set()
    assert pairs(spark, None, "", " ", " ", "a b", "a b", "x" * 50_000 + "é", "x" * 50_000 + "é") == {(4, 5), (6, 7)}
    clash = spark.createDataFrame([("f", 1, "a b", "s", "l"), ("f", 2, "a b", "s", "l")], SCHEMA + ", shown string, look string")
    assert same_looking_pairs(clash).count() == 1
    assert {r.record_id for r in canonical_texts(clash).collect()} == {1, 2}


def test_swapped_letters_keep_their_accents(spark):
    combining, composed = "Jab\u043e\u0301n de mano", "Jab\u03ccn de mano"  # Cyrillic o and U+0301; Greek omicron with tonos
    assert pairs(spark, "Jab\u00f3n de mano", combining, composed) == {(0, 1), (0, 2), (1, 2)}
    assert pairs(spark, "Jabon de mano", combining, "Jab\u00f2n de mano") == set()
    assert pairs(spark, "\u0451лка и \u0457жак", "\u00ebлка и \u00efжак") == {(0, 1)}  # Latin into Cyrillic


def test_joiners_between_pictures():
    cook = "\U0001f469‍\U0001f373"
    dirty = ["\U0001f469‍‌\U0001f373", "\U0001f469‌‍\U0001f373", "\U0001f469‍​\U0001f373‍", "\U0001f469‍‍\U0001f373"]
    assert {shown(t) for t in dirty} == {cook} != {shown("\U0001f469‌\U0001f373")}
    assert shown("a‍b‌c") == "abc" and shown("ن‌م") == "ن‌م"


def test_each_step_is_marked(spark):
    texts = ["casa cop nueva", "casa сор nueva", "cаsa nueva", "Lаpidabi", "Lapidаbi", "casa хе nueva"]
    got = {r.record_id: (r.canonical, r.steps) for r in canonical_texts(spark.createDataFrame([("f", i, t) for i, t in enumerate(texts)], SCHEMA)).collect()}
    assert got == {0: (texts[0], []), 1: (texts[0], ["whole"]), 2: ("casa nueva", ["mixed"]), 3: ("Lapidabi", ["agreed"]), 4: ("Lapidabi", ["agreed"]), 5: (texts[5], [])}
