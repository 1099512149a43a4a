from betaloom.llm.spam import MANY_HOSTS, hosts_per_phrase, list_evidence, pages, shingles, word_hashes
from pyspark.sql import functions as F

LINKS = "\n".join(f"https://a{i}.example/x{i}" for i in range(12))
SPAM = [
    "cheap shoes buy shoes best shoes online shoes cheap shoes sale shoes buy shoes best shoes order shoes cheap shoes sale shoes",
    LINKS,
    "We had the same problem with this tool.\n\n" + LINKS,
    " ".join(f'<a href="http://b{i}.test/q">pet bed sale</a><br>' for i in range(10)),
    "\n".join(f"pet bed SKU{1000 + i} red 9.99 XL" for i in range(12)),
    "```\n" + " ".join(f"#petbed{i} #cheapbed{i} #sale" for i in range(12)) + "\n```",
]
HAM = [
    None,
    "",
    "See https://a.example/x",
    "No.",
    "\n".join(f"- https://a{i}.example/x This page explains how the parser reads the table and why it fails." for i in range(10)),
    "\n".join(f"10:2{i % 10}:05 ERROR loader: parse table broken E{i}" for i in range(40)),
    "for x in table[1:]:\n    print(x)\n" * 20,
    "\n".join(f"| parse_{i} | {i} | fast |" for i in range(30)),
    "The loader reads the table twice, which is why it takes so long on my machine. I would not change the cache by hand, since the tool does it for you.",
]


PROSE = [
    "Wczoraj próbowałem uruchomić program na starym komputerze, ale nic z tego nie wyszło. Po kilku godzinach znalazłem przyczynę w pliku ustawień. Teraz wszystko działa tak, jak powinno.",
    "Вчера я пытался запустить программу на старом компьютере, но ничего не вышло. Через несколько часов я нашёл причину в файле настроек. Теперь всё работает так, как должно.",
    "Ieri ho provato ad avviare il programma su un vecchio computer, ma senza successo. Dopo qualche ora ho trovato la causa nel file delle impostazioni. Adesso funziona tutto.",
    "昨天我试着在旧电脑上运行这个程序，但是没有成功。几个小时以后，我在设置文件里找到了原因。现在一切正常。",
    "so i tried to run it on my old machine and it did not work at all then after a few hours i found that the cause was in the settings file and now it all works as it should do",
]
NOTES = """- ask Anna about the loader before we go on
- the parser wants a newer table
- Ben saw the same thing on his machine last week
- look at the log again when the job is done
- no idea why it was slow on the first run
- write to the list if it is still there in May
- two of the old files are not read at all
- somebody has to move the archive out of the way
- check with Cleo what she did about the index
- it may be the disk but the other box is fine
- put the notes from the call in here
- keep an eye on the queue over the weekend"""
STUFFED = [
    "cheap shoes for the best shoes in the shop and the sale of the shoes " * 10,
    "Cheap shoes for the best shoes in the shop. " * 10,
    "Shoes sale: shoes? Buy shoes shoes cheap. Best shoes, shoes and shoes sale! Shoes shop cheap shoes. Order shoes: shoes online?",
    "\n".join(f'<a title="{"x" * 2500}" href="http://b{i}.test/{"y" * 2500}">pet bed sale</a>' for i in range(10)),
    "s\u200bh\u200bo\u200be\u200bs sale cheap shoes sh\u200boes online " * 6,
]


def evidence(spark, texts):
    d = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    d = d.na.fill("").withColumn("w", word_hashes(F.col("text")))
    return list_evidence(d, "text", "w").orderBy("id").collect()


def test_density(spark):
    got = evidence(spark, SPAM)
    assert all(r["density"] > 0.5 for r in got), got
    assert all(r["density"] < 0.25 for r in evidence(spark, [t for t in HAM if t and len(t) > 30]))
    assert [r["density"] for r in evidence(spark, ["", "   "])] == [0, 0]


def test_no_language_is_spam(spark):
    rows = [(i, i, t) for i, t in enumerate([*PROSE, NOTES, *STUFFED])]
    got = {r["id"] for r in pages(spark.createDataFrame(rows, "id long, host long, text string"), "id", "host", "text").filter("flagged").collect()}
    assert got == set(range(len(PROSE) + 1, len(rows)))


def test_one_text_on_many_hosts(spark):
    ad = "Our new clinic opens its doors this month. Call today and ask for the spring offer, which covers the first visit and all tests. We look forward to seeing you and your family."
    rows = [(i, i, ad) for i in range(MANY_HOSTS + 20)] + [(100 + i, 7, ad.upper() + " Twice.") for i in range(2)] + [(200 + i, 200 + i, PROSE[0]) for i in range(5)] + [(300 + i, 300 + i, "Works for me, thanks a lot.") for i in range(60)]
    got = {r["id"]: r for r in pages(spark.createDataFrame(rows, "id long, host long, text string"), "id", "host", "text").collect()}
    assert {i for i, r in got.items() if r["flagged"]} == set(range(MANY_HOSTS + 20))
    assert got[0]["copied"] == 1 and got[0]["density"] == 0 and got[200]["stitched"] == 1 and got[200]["copied"] == 0


def test_hosts_per_phrase_equals_brute_force(spark):
    rows = [(h % 7, (h * h) % 11) for h in range(200)]
    got = {r["sh"]: r["n_hosts"] for r in hosts_per_phrase(spark.createDataFrame(rows, "host long, sh long")).collect()}
    assert got == {s: len({h for h, x in rows if x == s}) for s in {x for _, x in rows}}


def test_very_long_text_is_read_whole(spark):
    long = ["The loader reads the table twice. " * 20_000 + LINKS, "pet bed sale " * 100_000 + "The loader reads it.", "a." * 50_000, "<" * 50_000 + "[" * 50_000]
    got = evidence(spark, long)
    assert got[0]["density"] < 0.25 and got[0]["bare_links"] == 12
    assert got[1]["density"] > 0.9 and got[1]["bare_words"] == 300_004 and got[1]["bare_keyed"] > 0.99


def test_pages(spark):
    rows = [(i, i % 3 if i else None, t, "x", "y") for i, t in enumerate(SPAM + HAM)]
    d = spark.createDataFrame(rows + rows[:1], "id long, host long, text string, density string, sh string")
    got = {r["id"]: r for r in pages(d, "id", "host", "text").collect()}
    assert len(got) == len(rows) and {i for i, r in got.items() if r["flagged"]} == set(range(len(SPAM)))
    assert pages(d.limit(0), "id", "host", "text").count() == 0


def test_shingles_and_hosts(spark):
    d = spark.createDataFrame([("a b c d e f",), ("A, b; c d e",), ("a b",), ("",), (None,)], "t string")
    got = [r[0] for r in d.select(word_hashes(F.col("t")).alias("w")).select(shingles("w")).collect()]
    assert len(got[0]) == 2 and got[1][0] == got[0][0] and got[2] == [] and got[3] == []


def test_phrases_bring_pages_in(spark):
    stuffed = "buy the best shoes in the city for the best price of the year and " * 8  # prose by its function words
    short = "cheap shoes best shoes order shoes sale"  # too few words for list density
    code = "for x in table[1:]:\n    print(x)\n" * 20
    copy = HAM[-1]
    rows = [(1, 1, stuffed), (2, 2, short), (3, 3, short), (4, 4, copy), (5, 5, copy), (6, 6, code), (7, 7, "No."), (8, 8, "cheap boots best boots order boots sale"), (9, 9, HAM[-1] + " Twice."), (9, 9, HAM[-1] + " Twice.")]
    got = {r["id"]: r for r in pages(spark.createDataFrame(rows, "id long, host long, text string"), "id", "host", "text").collect()}
    assert {i for i, r in got.items() if r["flagged"]} == {1, 2, 3}
    assert got[2]["bare_words"] < 20 and got[1]["stitched"] == got[2]["stitched"] == got[4]["stitched"] == 1
    assert got[7]["stitched"] is None and got[8]["stitched"] == 0 and got[9]["repeated"] == 0


def test_stitched_share_of_every_page(spark):
    rows = [(1, 1, "a b c d e f g"), (2, 2, "x a b c d e y"), (3, 1, "c d e f g h"), (4, 3, "p q r s t p q r s t p q r s t"), (5, 4, None)]
    got = {r["id"]: r["stitched"] for r in pages(spark.createDataFrame(rows, "id long, host long, text string"), "id", "host", "text").collect()}
    # c d e f g stands twice, but with one host
    assert got == {1: 1 / 3, 2: 1 / 3, 3: 0, 4: 1, 5: None}
