import pytest

from quern.llm import mojibake as M

CLEAN = {
    "fr": "Le préfet a cédé le château à la région après l’été. Né à Sète, le géographe a été élu.",
    "ru": "Старая крепость была построена раньше города. Почему лодочник покинул деревню?",
    "zh": "老人说：“这不是城市的一部分。我们都知道。”为什么要离开呢？",
    "ja": "川幅は広く、村を隔てている。誰が橋を建てたのか？水車は移された。",
    "el": "Ποιος έχτισε το γεφύρι ανάμεσα στα χωριά; Το έτος η αγορά μεταφέρθηκε.",
    "pt": "MAÇÃ, IRMÃ, AMANHÃ: A FUNDAÇÃO NÃO É A DE LÁ. A irmã comprou maçãs.",
    "odd": "Þórð Æðelric & Đức – «mots» √2 ≠ 1 ├── index § 4 · 50 € “quoted” naïve café",
    "en": "Plain words only.",
}


def corpus():
    return [(i * 10 + k, text) for i in range(12) for k, text in enumerate(CLEAN.values())]


DAMAGE = {
    901: CLEAN["fr"].encode().decode("cp1252", "replace") if False else "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in CLEAN["fr"].encode()),
    902: CLEAN["fr"].encode().decode("latin-1"),
    903: CLEAN["ru"].encode().decode("mac_roman"),
    904: CLEAN["ru"].encode("cp1251").decode("latin-1"),
    905: CLEAN["zh"].encode("gb18030").decode("latin-1"),
    906: CLEAN["ja"].encode("euc_jp").decode("latin-1"),
    907: CLEAN["fr"].encode().decode("latin-1").encode().decode("latin-1"),
    908: CLEAN["en"] + " " + CLEAN["fr"].encode().decode("cp437") + " " + CLEAN["ja"],
    909: CLEAN["el"].encode().decode("latin-1"),
}
DOCS = "doc_id bigint, text string, gain string, token string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None) for i, t in rows], DOCS)


def test_found_and_restored(spark):
    docs = frame(spark, [*corpus(), *DAMAGE.items(), (910, "Le pr�fet a c�d�"), (911, None), (912, ""), (None, DAMAGE[902])])
    assert {r[0] for r in M.garbled_documents(docs).collect()} == {*DAMAGE, 910}
    restored = {r["doc_id"]: r["restored"] for r in M.restored_documents(docs).collect()}
    for i, key in ((901, "fr"), (902, "fr"), (903, "ru"), (904, "ru"), (907, "fr"), (909, "el"), (905, "zh"), (906, "ja")):
        assert restored[i] == CLEAN[key], i
    assert restored[908] == CLEAN["en"] + " " + CLEAN["fr"] + " " + CLEAN["ja"] and restored[910] == "Le préfet a cédé"


def test_clean_empty_and_long(spark):
    assert M.garbled_documents(frame(spark, corpus())).count() == 0
    assert M.garbled_documents(frame(spark, [])).count() == 0
    long = [(1, DAMAGE[902] * 300), (1, DAMAGE[902] * 300), (2, CLEAN["fr"] * 300)]
    assert [r[0] for r in M.garbled_documents(frame(spark, [*corpus(), *long])).collect() if r[0] < 3 and r[0] > 0] == [1]


@pytest.mark.parametrize("page", M.READ_AS)
def test_round_trip_of_code_pages(page):
    back = {b: c for c, b in reversed(M.byte_table(page).items())}
    for text in ("é", "“quoted”", "ж", "漢字"):
        shown = "".join(back.get(b, chr(b)) if b > 127 else chr(b) for b in text.encode())
        found = M.as_utf8(shown, page)
        assert found is not None and found[0] == text


def test_open_letters_of_lost_bytes():
    shown = "caf" + "√�"
    text, sequences = M.as_utf8(shown, "mac_roman")
    assert text[:3] == "caf" and sequences == 0 and len(text) == 4
    assert M.may_be("é", text[3]) and M.may_be("Ó", text[3]) and not M.may_be("ж", text[3]) and not M.may_be("°", text[3])
    assert M.as_utf8("�©t", "cp1252") is None  # that page has all first bytes
    first_lost, _ = M.as_utf8("�®t", "cp1253")  # the second byte tells the place within each block of 64
    assert M.may_be("Ү", first_lost[0]) and not M.may_be("Ұ", first_lost[0])
    assert M.open_letter([0xC3, None], "cp1251") == "Ø"  # that page lacks one byte only
    assert M.open_letter([0xE3, None, 0x9F], "cp1252") == "た" and M.open_letter([0xE2, 0x80, None], "cp1252") == "”"
    han = M.open_letter([0xE6, None, 0xA8], "cp1252")
    assert [b for b in range(0x80, 0xC0) if M.may_be(bytes([0xE6, b, 0xA8]).decode(), han)] == [0x81, 0x8D, 0x8F, 0x90, 0x9D]
    for data in ([0xC3, None], [None, 0xA9], [0xE6, None, None], [None, 0xBC, 0xA2], [0xE6, 0xBC, None]):
        for letter in ("é", "漢", "ж"):
            b = letter.encode()
            assert M.may_be(letter, M.open_letter(data)) == (len(b) == len(data) and all(x is None or x == y for x, y in zip(data, b)))


def test_lost_letters_keep_every_known_letter(spark):
    clean = ["Он сказал: привет всем. Были другие города.", "Το γεφύρι είναι παλιό και μεγάλο.", "川幅は広く、村を隔てている。", "La señora vivió en la región. PRÉFET ÉLU", "Другие вести пришли."]
    lost = {
        701: ("Он сказал: п�ивет всем", "Он сказал: привет всем"),
        702: ("Το γεφ�ρι είναι π�λι�", "Το γεφύρι είναι παλιό"),
        703: ("川幅�広く、村を隔て�いる。", "川幅は広く、村を隔てている。"),
        704: ("La se�ora vivi� en la regi�n. PR�FET", "La señora vivió en la región. PRÉFET"),
        705: ("Он п�ишёл и ж�г", "Он п�ишёл и ж�г"),  # no word of the corpus fits: the letters stay open
        706: ("� alone", "� alone"),
        707: ("П�ИВЕТ", "ПРИВЕТ"),
    }
    docs = frame(spark, [*((i * 10 + k, t) for i in range(12) for k, t in enumerate(clean)), *((i, t) for i, (t, _) in lost.items())])
    restored = {r["doc_id"]: r["restored"] for r in M.restored_documents(docs).collect()}
    assert restored == {i: t for i, (_, t) in lost.items()}
    assert {r[0] for r in M.garbled_documents(docs).collect()} == set(lost)


def test_lost_bytes_within_garbled_text(spark):
    table = {b: bytes([b]).decode("cp1252", "replace") for b in range(256)}
    shown = "".join(table[b] for b in CLEAN["ru"].encode())
    assert "�" in shown
    docs = frame(spark, [*corpus(), (901, shown), (902, shown + " п�ивет")])
    restored = {r["doc_id"]: r["restored"] for r in M.restored_documents(docs).collect()}
    assert restored[901] == CLEAN["ru"]
    assert restored[902] == CLEAN["ru"] + " п�ивет"


def test_repeated_ids_are_restored_each(spark):
    docs = frame(spark, [*corpus(), (901, DAMAGE[902]), (901, DAMAGE[903]), (901, CLEAN["el"]), (901, DAMAGE[902])])
    assert [r[0] for r in M.garbled_documents(docs).collect()] == [901]
    assert sorted(r["restored"] for r in M.restored_documents(docs).collect()) == sorted([CLEAN["fr"], CLEAN["ru"], CLEAN["fr"]])


def test_best_path_changes_reading_only_for_a_gain():
    rows = [(0, "", 30.0), (0, "utf8:x:1", 5.0), (1, "", 10.0), (1, "utf8:y:1", 9.0), (2, "", 30.0), (2, "utf8:x:1", 5.0)]
    gain, chosen = M.best_path(rows)
    assert chosen == {0: "utf8:x:1", 2: "utf8:x:1"} and gain == pytest.approx(46.0)
    assert M.best_path([]) == (0.0, {})


def test_western_text_read_as_cyrillic(spark):
    shown = CLEAN["fr"].encode("cp1252").decode("cp1251")
    homoglyphs = "Тhe mill оf the lаke is оld. A rоаd leads there."
    docs = frame(spark, [*corpus(), (901, shown), (902, homoglyphs)])
    assert [r[0] for r in M.garbled_documents(docs).collect()] == [901]
    # a word of one letter that both scripts have stays as it is stored
    assert M.restored_documents(docs).first()["restored"].replace(" а ", " à ") == CLEAN["fr"]


def test_old_cyrillic_page(spark):
    shown = CLEAN["ru"].encode("cp866").decode("cp1251", "replace")
    assert [r[0] for r in M.garbled_documents(frame(spark, [*corpus(), (901, shown)])).collect()] == [901]
