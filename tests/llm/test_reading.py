import random

from rastro.llm.reading import read_text, reading_levels, without_heading

EASY = ["el pan es bueno", "uso la mesa cada día", "la taza va con el agua", "me gusta el gato", "lo lavo con agua"]
HARD = ["la homologación presupone la idoneidad del componente frente a solicitaciones cíclicas", "la viscosidad residual condiciona sustancialmente la interoperabilidad de los accesorios", "la normativa vigente exacerba la responsabilidad subsidiaria del distribuidor"]
DOCS = "doc_id bigint, text string, lang string"
LABELS = "doc_id bigint, rater string, reading_level int, rated_at string"


def corpus(n):
    rng = random.Random(1)
    out = []
    for i in range(n):
        hard = i % 10 < 3
        parts = [rng.choice(HARD if hard and rng.random() < 0.85 else EASY) for _ in range(rng.randrange(4, 12))]
        out.append((i, ", ".join(parts) + "." if hard else ". ".join(parts) + ".", "es" if i % 20 else None, hard))
    return out


def test_held_out_accuracy(spark):
    docs = corpus(400)
    labels = [(i, f"r{r}", (5 if hard else 1) if (i + r) % 17 else 3, "t") for i, _, _, hard in docs if i % 2 for r in range(3)] + [(1, "r9", None, "t")]
    rows = reading_levels(spark.createDataFrame([d[:3] for d in docs], DOCS), spark.createDataFrame(labels + labels, LABELS)).collect()
    truth = {i: hard for i, _, _, hard in docs}
    held = [r for r in rows if r.doc_id % 2 == 0]
    assert sum(r.demanding == truth[r.doc_id] for r in held) / len(held) > 0.95
    assert all(1 <= r.level <= 5 for r in rows)
    assert {r.lang for r in rows} == {"es"}


def test_nothing_to_rate(spark):
    docs = corpus(60)
    odd = [(1001, None, "es"), (1002, "", "es"), (1003, "  \n ", "en"), (1004, "这是中文的说明书。请小心使用。", "zh"), (1005, "⭐⭐⭐ 123", "es"), (1006, "x" * 100_000, "es")]
    df = spark.createDataFrame([(*d[:3], 1, "z") for d in docs] + [(*o, 1, "z") for o in odd], DOCS + ", n_words int, level string")
    rows = {r.doc_id: r for r in reading_levels(df, spark.createDataFrame([], LABELS)).collect()}
    assert all(rows[i].level is None and rows[i].demanding is None for i in range(1001, 1006))
    assert rows[1006].n_words == 1
    assert all(r.level is None and r.demanding is None for r in rows.values())  # no ratings, no levels
    assert reading_levels(df.limit(0), spark.createDataFrame([], LABELS)).collect() == []


def test_languages_are_those_of_the_corpus(spark):
    french = [(2000 + i, "le pain est bon. la table est grande.", "fr") for i in range(6)]
    rare = [(3000, "das Brot ist gut", "de"), (3001, "el pan es bueno", "und"), (3002, "le pain est bon", "")]
    docs = [d[:3] for d in corpus(60)]
    labels = [(d[0], "r", 5 if d[3] else 1, "t") for d in corpus(60)]
    rows = {r.doc_id: r for r in reading_levels(spark.createDataFrame(docs + french + rare, DOCS), spark.createDataFrame(labels, LABELS)).collect()}
    assert rows[2000].lang == "fr" and rows[2000].unfamiliar == 0 and rows[2000].demanding is False
    assert rows[3000].lang is None and rows[3000].level is None
    assert rows[3001].lang == "es" and rows[3002].lang == "fr"


def test_reading():
    assert without_heading("Marca X 20 cm | azul: El pan es bueno") == "El pan es bueno"
    assert without_heading("El pan es bueno. Es azul") == "El pan es bueno. Es azul"
    assert read_text("El pan es bueno\nla mesa es azul") == (["el", "pan", "es", "bueno", "la", "mesa", "es", "azul"], 2)
    assert read_text("Fácil​ y cómodo!!! Sí.") == (["facil", "y", "comodo", "si"], 2)
    assert read_text("中文") == ([], 0)
