import pytest

from tidemark.llm.stuffing import Skeletons, StuffingLimits, common_words, judged, measure, script_of

PROSE = "The load stopped after the second file because the key was not unique. We kept the older rows and wrote the reason to the log. Nobody had changed the table since the week before, so the team will look at the source when it is open again. "
SUBJECTS = ["The nightly load", "Our oldest table", "A second team", "The row hash", "Nobody in the shop", "The last export", "Every new key", "This report"]
VERBS = ["stopped after", "was compared with", "had moved", "will replace", "kept all of", "lost most of", "wrote over", "could not read"]
OBJECTS = ["the rows of last week", "a file from the source", "the prices in the log", "two columns without names", "an order that was open", "the history of the seller"]
TAILS = ["because the key was not unique", "when the disk filled up", "although nobody had changed it", "and the totals were right again", "before anyone looked at it"]
VARIED = [" ".join(f"{SUBJECTS[(i * 3 + j * 5) % 8]} {VERBS[(i + j * 3) % 8]} {OBJECTS[(i * 5 + j) % 6]} {TAILS[(i + j * 2) % 5]}." for j in range(3 + i % 12)) for i in range(120)]
KEYWORDS = "cheap door mat online best door mat buy cheap mat near me best online door mat buy " * 12
FAKE = "Cheap door mat online best. Best online door mat buy! Near me cheap mat buy. Door mat cheap best online! " * 8
LINKS = "\n".join(f"https://www.shop{i}.example/{i * 7}/item{i}.html" for i in range(40))
TAGS = ", ".join(f"new {a} {b}{i}" for i, (a, b) in enumerate([("lamp", "SKU"), ("mat", "cm"), ("pot", "x"), ("shelf", "SKU")] * 15))
HASHTAGS = " ".join(f"#word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(70))
LOG = "\n".join(f"2024-01-{i % 28 + 1:02d} 10:{i % 60:02d}:07 INFO [run_{i:05d}] load.table rows={i * 37} the load of table {i} ended" for i in range(40))
TABLE = "\n".join(f"| name{i} | {i * 31} | {i * 7} |" for i in range(40))
CONTRACT = "system: shop\nobject: orders\ncolumns:\n" + "\n".join(f"  - name: column_{i}\n    type: string\n    nullable: true\n    description: {VARIED[i + 12 * (i % 3)][:90]}." for i in range(20))
ANNOTATED = "\n".join(f"https://www.site{i}.example/ - {VARIED[i + 20]}" for i in range(0, 20, 3))
FOREIGN = {
    "tr": "Dün akşam şehirdeki kütüphane, tadilatın ardından yeniden kapılarını açtı. Açılışa katılan okurlar, yeni okuma salonunun eskisine göre çok daha aydınlık olduğunu söyledi. Müdür, önümüzdeki ay çocuklar için bir kitap kulübü kurmayı planladıklarını belirtti.",
    "pl": "Wczoraj wieczorem w naszym mieście otwarto nową bibliotekę, na którą mieszkańcy czekali kilka lat. Podczas uroczystości burmistrz podziękował wszystkim, którzy pomogli w budowie. Od przyszłego tygodnia czytelnia będzie czynna także w niedziele.",
    "fi": "Kaupungin uusi kirjasto avattiin eilen illalla pitkän remontin jälkeen. Monet kävijät kehuivat valoisaa lukusalia ja hiljaisia työtiloja. Johtajan mukaan lapsille järjestetään syksyllä oma lukupiiri, johon voi ilmoittautua heti.",
    "id": "Perpustakaan baru di kota kami dibuka kemarin malam setelah perbaikan yang panjang. Banyak pengunjung memuji ruang baca yang terang dan tenang. Menurut kepala perpustakaan, bulan depan akan ada klub buku untuk anak-anak.",
    "hu": "Tegnap este megnyitották a város új könyvtárát, amelyre a lakók évek óta vártak. A látogatók szerint az olvasóterem sokkal világosabb lett, mint korábban volt. Az igazgató elmondta, hogy ősszel gyerekeknek szóló olvasókört indítanak.",
    "sw": "Maktaba mpya ya mji wetu ilifunguliwa jana jioni baada ya matengenezo marefu. Wageni wengi walisifu ukumbi wa kusomea kwa kuwa na mwanga wa kutosha. Mkurugenzi alisema kwamba mwezi ujao kutakuwa na klabu ya vitabu kwa watoto.",
}
CHINESE = "便宜手机壳最好手机壳在线购买。" * 20
SHOES = "the best shoes of the cheap shoes " * 40
CASES = {"keywords": KEYWORDS, "fake": FAKE, "links": LINKS, "tags": TAGS, "hashtags": HASHTAGS, "led": PROSE[:71] + KEYWORDS, "shoes": SHOES, "brief": "buy mat " * 6}
NO_CASES = {"prose": VARIED[11], "twice": PROSE * 2, "log": LOG, "table": TABLE, "contract": CONTRACT, "annotated": ANNOTATED, "tail": VARIED[10] + TAGS[:200], "null": None, "empty": "", "blank": " \n\t", "short": "a b"}


@pytest.fixture(scope="module")
def verdicts(spark):
    data = [(k, t, "en", 1) for k, t in {**CASES, **NO_CASES}.items()] + [("links", LINKS, "en", 1), ("zh", CHINESE, "zh", 1)]
    data += [(k, t, x, 1) for k, t in FOREIGN.items() for x in (k, None)]
    data += [(f"usual{i}", VARIED[i], "en", 1) for i in range(len(VARIED))]
    df = spark.createDataFrame(data, "doc_id string, text string, lang string, ratio long")
    return judged(df, key="doc_id", text="text", lang="lang").collect()


def test_cases_and_no_cases(verdicts):
    assert sorted(r.doc_id for r in verdicts if r.stuffed) == sorted([*CASES, "links", "zh"])  # a repeated row comes out twice


def test_every_row_is_judged(verdicts):
    assert len(verdicts) == len(CASES) + len(NO_CASES) + 2 + 2 * len(FOREIGN) + len(VARIED)


def test_without_a_corpus(spark):
    """With too few documents for any figure the fixed line holds."""
    data = [(k, t, k) for k, t in FOREIGN.items()] + [("zh", CHINESE, "zh"), ("shoes", SHOES, None), ("prose", PROSE, None)]
    got = judged(spark.createDataFrame(data, "doc_id string, text string, lang string"), key="doc_id", text="text", lang="lang").collect()
    assert sorted(r.doc_id for r in got if r.stuffed) == ["shoes", "zh"]


def test_whole_text_counts(spark):
    """Stuffing after a long beginning weighs as much as before it."""
    data = [("a", VARIED[11] + KEYWORDS * 4, "en"), ("b", KEYWORDS * 4 + VARIED[11], "en"), ("c", " ".join(VARIED) + KEYWORDS * 4, "en"), ("d", KEYWORDS * 400, "en")]
    got = {r.doc_id: r.stuffed for r in judged(spark.createDataFrame(data, "doc_id string, text string, lang string"), key="doc_id", text="text", lang="lang").collect()}
    assert got == {"a": True, "b": True, "c": False, "d": True}


def test_blocks_and_scripts():
    limits = StuffingLimits(block=100)
    blocks = measure("x" * 250, None, limits)
    assert [b[0] for b in blocks] == [84, 84, 82] and all(b[1] == 0 and b[4] is not None for b in blocks)
    assert measure("One two. Three 4567.", Skeletons(frozenset({"one"})), limits)[0][:3] == (20, 2, 0)
    assert measure("no 12 ends 3", None, limits)[0][:3] == (12, 0, 3)
    assert Skeletons(frozenset({"the", "of"})).of("The cat of \x01 12,5 x") == "The x of \x01 12,5 x"
    assert [script_of(t) for t in ("", "abc é", "привет", "日本", "हिन्दी")] == [0, 0, 4, 0x2E, 9]


def test_common_words(spark):
    df = spark.createDataFrame([(f"The x{i} word", "en") for i in range(40)] + [("der", "de")] * 3 + [(None, "en")], "text string, lang string")
    assert common_words(df, "text", "lang", StuffingLimits()) == {"en": frozenset({"the", "word", "x"})}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert judged(df, key="doc_id", text="text", lang="lang", limits=StuffingLimits()).collect() == []
