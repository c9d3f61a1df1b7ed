import pytest

from quern.llm.sentences import evidence_texts, sentence_units, spans


def cut(text):
    return [text[a:b] for a, b in spans(text)]


@pytest.mark.parametrize("parts", [
    ["Dr. Orvan met J. K. Rill at 9:16 p.m.", "49 boats left.", "von Kestrov sold it."],
    ["In 36 B.C. the guild left.", "It broke in 65 B.C.", "Then it was quiet."],
    ["Gov. Teslo ruled from the U.N.S. mill.", "Version 2.92.1 lists A vs. B on fig. 7.", "The entry notes.36.txt on atlas.example/mill?id=3 names A."],
    ['The abbot said that "It will never yield!" and left.', 'He wrote: "It owes everything. All of it."', "(It was later sold.)", "Why?"],
    ['Mrs. Orvan called it "a tall mill. A red one. And ours", which he denied.', '"Was it A or B?" the clerk asked.'],
    ["The mill ... or what is left of it ... stands.", "Goods (e.g. tin, salt, etc.) went by No. 4 ferry.", "The price fell to 0.40 crowns, i.e. half."],
    ["Sgt. A, Capt. B et al. held it (cf. ch. 5).", "The road rises approx. 7 m.", "The deed was signed by Hill Bros.", "A & Sons Ltd. in May paid."],
    ["Am 3. März kam er.", "Im 16. Jahr z. B. nichts.", "Er ist ca. 15.9 m tief.", "„Wir gehören dazu!“, rief der Müller."],
    ["« Il ne cédera jamais ! » écrivait le préfet.", "Où passait-il ?", "M. Pascort a cédé tout."],
    ["¿Quién fundó A?", "¡Qué lejos queda!", "El Sr. Teslo llegó.", "Págs. 12 y ss. del códice lo dicen."],
    ["В 1835 г. мельница сгорела.", "Соль, воск и т. д. везли.", "«Мы отсюда», — сказал лодочник."],
    ["Ποιος έχτισε το γεφύρι;", "Ο κ. Sarvelli έζησε εδώ."],
    ["قال د. Orvan نعم.", "من بنى الجسر؟"],
    ["دریا گہرا ہے۔", "کیا یہ پرانا ہے؟"],
    ["डॉ. Orvan ने लिखा।", "क्या यह पुराना है?"],
    ["Այն հին է։", "Այն նոր է։"],
    ["በ1873 ዓ.ም. ተዛወረ።", "ይገኛል።"],
    ["ស្ពានចាស់។", "ផ្សារថ្មី។"],
    ["မြစ်ရှိသည်။", "ပို့ခဲ့သည်။"],
    ['"이것은 우리 땅이다."라고 말했다.', "거리는 4.9km이다."],
])
@pytest.mark.parametrize("between", [" ", "\n", " ", "  "])
def test_with_spaces(parts, between):
    assert cut("  " + between.join(parts) + " ") == parts


@pytest.mark.parametrize("parts", [
    ["川幅は2.1メートルだ。", "誰が建てたのか？", "「遠い。とても遠い。」と船頭は言った。"],
    ["老人说：“不是。我们都知道。”", "为什么要离开呢？", "河宽5.2米！"],
    ["It fell after the floods.", "Most of it came back.", "How far it looked!", "Nobody knows."],
])
def test_without_spaces(parts):
    assert cut("".join(parts)) == parts


def test_thai():
    assert cut("สะพานยาว 25 เมตร ไม่มีใครจำได้ เมืองUpper Ribuอยู่เหนือ\nตลาดย้ายเมื่อปี 1590 ตามบันทึก") == ["สะพานยาว 25 เมตร", "ไม่มีใครจำได้", "เมืองUpper Ribuอยู่เหนือ", "ตลาดย้ายเมื่อปี 1590 ตามบันทึก"]


def test_spellings_of_marks():
    assert cut("Аt 6 а.m. it rang. Ｗｈｙ？　Ｎｏ．") == ["Аt 6 а.m. it rang.", "Ｗｈｙ？", "Ｎｏ．"]
    assert cut("Págs. 12 del códice. Fin.") == ["Págs. 12 del códice.", "Fin."]
    assert cut("See ﬁg. 7 here. End") == ["See ﬁg. 7 here.", "End"]
    assert cut("On​e. Tw­o.​") == ["On​e.", "Tw­o.​"]


@pytest.mark.parametrize("text", [None, "", " \n "])
def test_nothing(text):
    assert spans(text) == []


def test_odd_texts():
    assert cut("no mark") == ["no mark"] and cut("(open and never closed. Yes.") == ["(open and never closed.", "Yes."]
    assert cut('a " quote alone. Next one.') == ['a " quote alone.', "Next one."]
    assert cut("...") == ["..."] and cut("?!") == ["?!"]
    text = "The mill stands here. " * 20_000
    assert len(spans(text)) == 20_000
    assert len(spans("(" * 5000 + "a.")) >= 1


@pytest.mark.parametrize("parts", [
    ["(He said “hello) and left.", "It rained.", "The sun came out.”", "Later it ended.", "Done here."],
    ['It is a 5" pipe.', "It is long.", 'He has a 3" one.'],
    ["It rained :( all day.", "We left :)", "Then it ended."][:1] + ["Then it (really) ended."],
    ["He said ‘Stop. Go away.’ and left.", "She said 'Stop. Go away.' and left.", "The dogs’ bowl isn't here.", "It’s gone."],
    ["The word λόγος is Greek; it means word; so they say.", "Ποιος είναι;", "Yes; and no."],
    ["“It is (so. He “thinks” so. They say.) It ends. Yes.”", "Done."],
    ["It (a stray one stands. here", "And more."][:0] + ["One [note. here] two.", "Three."],
])
def test_marks_that_cross_or_stay_open(parts):
    assert cut(" ".join(parts)) == parts


def test_blank_line_empties_the_stack():
    assert cut("He said “it never closes. Really.\n\nNext one. Last ”one.") == ["He said “it never closes.", "Really.", "Next one.", "Last ”one."]


@pytest.mark.parametrize("text,parts", [
    ("1. Open the door. 2. Close it. 3. Leave.", ["1. Open the door.", "2. Close it.", "3. Leave."]),
    ("1. Open the door 2. Close it", ["1. Open the door 2. Close it"]),
    ("1. Apples\n2. Pears\n   a) green\n   b) red. Sweet.\n3. Plums", ["1. Apples", "2. Pears\n   a) green", "b) red.", "Sweet.", "3. Plums"]),
    ("- one\n- two. More.\n- three", ["- one", "- two.", "More.", "- three"]),
    ("(i) first\n(ii) second\n(iii) third", ["(i) first", "(ii) second", "(iii) third"]),
    ("It has 3\n2. of these", ["It has 3\n2.", "of these"]),
])
def test_list_levels(text, parts):
    assert cut(text) == parts


@pytest.mark.parametrize("piece", ["(", "“", "q “( ", "1. ", "a) ", "; (", " 3. März ", '5" "', "\n- x", ": “a.” ", "[b] "])
def test_time_is_linear(piece):
    import time

    began = time.process_time()
    spans("x" + piece * 40_000 + " end.")
    assert time.process_time() - began < 8


def test_rows(spark):
    schema = "evidence_id bigint, unit_no string, evidence_sentences array<struct<sentence_id:bigint,text:string,page_title:string,page_url:string>>"
    rows = [(1, "clash", [(0, "Ab. Cd.", None, None), (1, None, None, None), (2, " ", None, None)]), (2, None, None), (3, None, []), (None, None, [(None, "Xy z.", None, None)])]
    got = [tuple(r) for r in sentence_units(evidence_texts(spark.createDataFrame(rows, schema)), ["evidence_id", "sentence_id"]).collect()]
    assert sorted(got, key=str) == sorted([(1, 0, 0, 0, 3), (1, 0, 1, 4, 7), (None, None, 0, 0, 5)], key=str)
    assert sentence_units(evidence_texts(spark.createDataFrame([], schema)), ["evidence_id"]).count() == 0
