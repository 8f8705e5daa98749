from datetime import datetime

from rastro.llm import listings
from rastro.llm.listings import group_listings, maker_key, parse_title, same_product_edges, same_product_pairs, star_clusters

SCHEMA = "listing_id bigint, title string, brand string, ingested_at timestamp_ntz"
CLASSES = "class_id bigint, facts string, maker string, tokens array<struct<df:int,token:string,weight:double>>, variants array<string>, against array<string>"
T = datetime(2026, 1, 1)
LINES = ["Nalefema", "Pokafama", "Kabidofe", "Lilimada", "Gomareba", "Kanokono", "Falagoli", "Nogebile"]
MAKERS = ["Korvano", "Fondusk", "Grevusk", "Testomar", "Lumbelia", "Haldix", "Pellava", "Arqoria"]


def listing_rows():
    """Eight makers with a line each, in two colours; every product has three listings: with code and line, with line, with code."""
    rows, truth = [], {}
    for m, (maker, line) in enumerate(zip(MAKERS, LINES, strict=True)):
        for c, (es, en) in enumerate((("rojo", "red"), ("azul marino", "navy"))):
            code = f"{maker[:2]}-100{m}21{c}{'AC'[c]}"
            titles = [f"{maker} {line} Manta de sofá {code} 1,5 m {es} Envío Gratis", f"Manta polar «{line.upper()}» 150 centímetros color {en} 1 ud.", f"Original Manta de sofá {code.lower().replace('-', '')} 1500 mm {es.title()}"]
            for k, title in enumerate(titles):
                i = 100 * m + 10 * c + k
                rows.append((i, title, [maker, f"Marca: {maker}", None][k], T))
                truth[i] = (m, c)
    return rows, truth


def test_groups(spark):
    rows, truth = listing_rows()
    rows += rows[:5] + [(900, None, None, T), (901, "", "Korvano", T), (902, "azul", None, T), (None, "Korvano Nalefema", "Korvano", T), (0, "older title", "x", datetime(2025, 1, 1))]
    groups = group_listings(spark.createDataFrame([(*r, "z", 1) for r in rows], SCHEMA + ", key string, class_id int"))
    got = {(r.listing_a, r.listing_b) for r in same_product_pairs(groups).collect()}
    assert got == {(a, b) for a in truth for b in truth if a < b and truth[a] == truth[b]}
    assert {r.listing_id for r in groups.collect()} == set(truth) | {900, 901, 902}


def grouped(spark, titles):
    """Sets of indexes of the titles that fall into one group; all of one brand."""
    rows = [(i, t, "Korvano", T) for i, t in enumerate(titles)]
    groups = {}
    for r in group_listings(spark.createDataFrame(rows, SCHEMA)).collect():
        groups.setdefault(r.group_id, set()).add(r.listing_id)
    return sorted(map(sorted, groups.values()))


def test_colours_no_list_knows_stay_apart(spark):
    titles = [f"{lead} Nalefema Manta de sofá 150 cm {colour}" for colour in ("granate", "crema") for lead in ("Korvano", "Korvano Oferta")]
    assert grouped(spark, titles) == [[0, 1], [2, 3]]


def test_words_of_one_meaning_share_codes_and_exclude_nothing(spark):
    lines = [f"Line{a}{b}ana" for a in "abcd" for b in "efg"]
    titles = []
    for i, line in enumerate(lines):
        titles += [f"Korvano {line} Manta {w} 150 cm KO-70{i:02}1" for w in ("granate", "burgundy")]
    titles += [f"Korvano {lines[0]} Manta {w} 150 cm" for w in ("granate", "granate suave", "burgundy", "burgundy suave")]
    got = grouped(spark, titles)
    assert [0, 1, *range(len(titles) - 4, len(titles))] in got


def test_a_unit_before_a_code_is_none():
    assert parse_title("Sartén red 32 cm Pack de 6 GR-3651348C")[:2] == ("mm320|red|6", ["GR3651348C"])
    assert parse_title("Tarro Juego de 2 LT 9609947C 50 CL")[:2] == ("ml500||2", ["LT9609947C"])
    assert parse_title("5 kg 2000 ml")[:1] == parse_title("2000 ml, 5 kg")[:1] == ("g5000+ml2000||1",)


def test_codes_of_other_forms():
    assert [parse_title(t)[1] for t in ("Sony RX100M3", "Auriculares WH-1000XM4", "dsc-rx100m3", "Pila de 1800W 12000mAh 24h 30x40 2-en-1 USB3")] == [["RX100M3"], ["WH1000XM4"], ["DSCRX100M3"], []]
    assert [parse_title(t)[1] for t in ("Mod. TO 1234567-A", "TO-1234567A rojo", "de 1800 W")] == [["TO1234567A"], ["TO1234567A"], []]


def test_hot_blocks_are_split(spark):
    rows = [(i, "f", "m", [(1, f"c:{i}", 1.0), (50, "w:line", 1.5)], None, None) for i in range(50)]
    df = spark.createDataFrame(rows, CLASSES)
    assert {tuple(r) for r in same_product_edges(df, 0.45, hot_block=7).collect()} == {tuple(r) for r in same_product_edges(df, 0.45).collect()} == {(a, b) for a in range(50) for b in range(a + 1, 50)}


def test_empty(spark):
    assert group_listings(spark.createDataFrame([], SCHEMA)).collect() == []


def test_parsing():
    assert parse_title("Set 3 unidades Jarra «Kanokono» 150 cl white KF-6987720E")[:2] == ("ml1500|white|3", ["KF6987720E"])
    assert parse_title("KF 6987720-E jarra 1,5 L blanco x3")[:2] == ("ml1500|white|3", ["KF6987720E"])
    assert parse_title("x" * 100_000)[:2] == ("||1", [])
    assert maker_key("Marca: Korvano®") == maker_key("KORVANO España") == "korvano"
    assert maker_key("Marca blanca") is maker_key(None) is None


def test_join_equals_brute_force(spark):
    import random

    rng = random.Random(7)
    sets = {}
    for i in range(80):
        tokens = sorted({(d := rng.randrange(1, 9), f"w:{d}{rng.choice('abcd')}") for _ in range(rng.randrange(1, 5))})
        sets[i] = [(d, t, 1.0 + 10 / d) for d, t in tokens]
    df = spark.createDataFrame([(i, "f", "m", v, None, None) for i, v in sets.items()], CLASSES)
    got = {(r.a, r.b) for r in same_product_edges(df, 0.45).collect()}
    wanted = set()
    for a, x in sets.items():
        for b, y in sets.items():
            wx, wy = sum(t[2] for t in x), sum(t[2] for t in y)
            if a != b and (wx, a) < (wy, b):
                shared = sum(t[2] for t in x if t[1] in {u[1] for u in y})
                if shared and shared >= 0.45 * wx - 1e-9:
                    wanted.add((a, b))
    assert got == wanted


def test_stars(spark):
    edges = [(1, 2), (1, 3), (1, 4), (5, 4), (5, 6), (7, 8)]
    got = {r.class_id: r.centre for r in star_clusters(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5, 7: 7, 8: 7}


def test_stars_need_as_many_rounds_as_they_need(spark, monkeypatch):
    monkeypatch.setattr(listings, "COMPACT_ROUNDS", 2, raising=False)
    ring = [(i, i % 20 + 1) for i in range(1, 21)]  # equal degrees, ascending ids: one more centre a round
    got = {r.class_id: r.centre for r in star_clusters(spark.createDataFrame(ring, "a bigint, b bigint")).collect()}
    assert len(got) == 20
    assert all(got[got[k]] == got[k] for k in got) and all(got[k] == k or (k, got[k]) in ring or (got[k], k) in ring for k in got)
    assert not any(got[a] == a and got[b] == b for a, b in ring)  # no two centres are neighbours
