import pytest

from quern.llm import spam as S

PROSE = "The ferry leaves the pier at noon, and the bakers bring their bread to the harbour before it does. In winter the sea is rough, so that it often stays in port for a day or two. "


@pytest.mark.parametrize("text", [
    "buy cheap lamps, best lamps, discount lamps, lamps online, cheap lamps today, top lamps, lamps 2024, best cheap lamps, lamps sale, free lamps",
    "#buyLamps #bestLamps #cheapShoes #topTables #freeLamps #discountShoes #onlineTables #bestShoes",
    "\n".join(f"- https://shop{k}.example/item/{k} lamp" for k in range(12)),
    "".join(f'<a href="https://s{k}.example/">best lamp</a>\n' for k in range(9)),
    "Home > Lamps > Tables (12) > Chairs > Sofas (3) > Garden > Kitchen Tools > Bath > Offers > Contact > Imprint > Login",
    "Looking for cheap lamps? Our cheap lamps are the best cheap lamps in town. Get cheap lamps today, because cheap lamps means savings on cheap lamps. " * 3,
    "lamp table chair sofa garden kitchen hammer ladder bucket window curtain mirror carpet pillow blanket candle kettle spoon basket shelf drawer hook",
])
def test_spam(text):
    assert S.is_spam(text)


@pytest.mark.parametrize("text", [
    None, "", "Lamps", PROSE * 3, PROSE * 2 + "\nTags: lamps, tables, chairs", PROSE * 2 + "\n" + "\n".join(f"[{k}] A book https://b.example/{k}" for k in range(4)),
    "\n".join(f"**lamp {k}**: A lamp gives light to a room, and number {k} is made of glass." for k in range(8)),
    PROSE + "\n" + "\n".join(f"step={k} loss=2.{k} tokens_seen={k}00" for k in range(30)),
    PROSE + "\n" + "\n".join(f"data/part{k}.npz  {k}123  00ab34cd56ef78900{k}aabbccddeeff00" for k in range(20)),
    "| split | rows |\n|---|---|\n" + "\n".join(f"| part{k} | {k} |" for k in range(20)),
    PROSE.replace(". ", ".\n") * 2 + "The same closing sentence is written here for all readers. " + PROSE + "The same closing sentence is written here for all readers.",
    "没有人注意到完整的来源复制分片。相比之下，提示库解释旧的港口记录。大约十行表明小的噪声推迟安静的图书卡。",
    "Второй запрос сравнивает ответ, а последний счётчик дополняет местный слой. Прошло десять дней, прежде чем всё было готово без лишних слов.",
    "with open('x') as f:\n    rows = [r[2:] for r in f]\nprint(rows)\nwhile a < 3 and b:\n    a = b + 1",
    "The ferry leaves at noon\n" + "\n".join(f"step{k} loss2{k} tokens_seen{k}00 val{k}" for k in range(9)),
    "The ferry leaves at noon\n\nclass LampHarbour\n    read_lamps  7\n\n    def read_lamp_9self harbour_rows\n        selfread_lamps  harbour_rows  3\n        return selfread_lamps\n\nlamps_all  sortedread_lamps keylambda lamp_row lamp_row2",
])
def test_not_spam(text):
    assert not S.is_spam(text)


def test_query_gives_each_document_once(spark):
    bad = "buy cheap lamps, best lamps, cheap lamps, " * 20
    df = spark.createDataFrame([(1, bad, "x"), (2, PROSE, "x"), (3, None, "x"), (None, bad, "x"), (1, bad, "y"), (4, bad * 3000, "y")], "doc_id bigint, text string, n string")
    assert sorted(r["doc_id"] for r in S.find_spam(df).collect()) == [1, 4]
    assert S.find_spam(df.limit(0)).count() == 0


SALES = "Buy cheap running shoes online at our store today with free shipping and the best price"


@pytest.mark.parametrize("text", [
    (SALES + ". ") * 20, (SALES + " ") * 5, "".join(SALES.replace("today", city) + ". " for city in ("Bern", "Rome", "Oslo", "Riga", "Cork", "Lyon")), PROSE + (SALES + ".\n") * 6,
    (" ".join(f"word{chr(97 + k // 26)}{chr(97 + k % 26)} of the" for k in range(100)) + " ") * 5, "我们商店今天有便宜的跑鞋，免费送货，价格最好。" * 8, "便宜跑鞋的店有便宜跑鞋，买便宜跑鞋到便宜跑鞋店。",
])
def test_repeated_sales_phrases_are_spam_whatever_the_gaps(text):
    assert S.is_spam(text)


def test_autocorrelation_equals_brute_force():
    import numpy as np

    rng = np.random.default_rng(5)
    for n, period, noise in ((40, 7, 0.1), (300, 60, 0.3), (500, 120, 0.2), (400, 0, 0)):
        ids = rng.integers(0, 90, n) if not period else np.where(rng.random(n) < noise, rng.integers(0, 90, n), np.resize(rng.integers(0, 90, period), n))
        content = ids % 5 != 0
        want = max(float(((ids[k:] == ids[:-k]) & content[k:]).sum() / content[k:].sum()) for k in range(1, n // 2 + 1))
        assert S.autocorrelation(ids, content, n // 2, 0.5) == (want if want >= 0.5 else 0.0)
