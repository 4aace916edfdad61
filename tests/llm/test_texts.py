"""Quality, language, look-alikes, abuse, pair defects and personal information on written cases."""

import os

import numpy as np
import pyarrow as pa
import pytest

from kaghamar.llm import abuse, langid, lookalikes, pairs, personal, quality
from kaghamar.llm.personal_seeds import labelled
from kaghamar.llm.quality_seeds import PROSE, seeds


def frame(spark, texts, more="x"):
    rows = [(i, t, more, more, more) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "para_id long, text string, k string, t string, kind string")


ODD = [None, "", "   ", "\n\n", "a", "​", "x" * 300_000, "Գիրք։ " * 20_000, "\r\n", "😀", "\ud83d".encode("utf-8", "replace").decode()]


def test_kinds_of_seed_texts():
    for (kind, form), texts in seeds().items():
        for text in texts:
            if len(text) >= quality.MIN_CHARS and not form.startswith("encoded") and "ragged" not in form:
                assert quality.kinds_of(pa.array([text]))[0] == kind, (form, text)


def test_statistics(spark):
    texts = ["Տունը մեծ է։ Ծառը փոքր է, իսկ գետը հեռու է մեր գյուղից։\nԱնձրև է գալիս։", *ODD]
    rows = {r["para_id"]: r for r in quality.text_quality(frame(spark, texts)).collect()}
    assert len(rows) == len(texts)
    assert (rows[0]["n_words"], rows[0]["n_lines"], rows[0]["stop_line_share"], rows[0]["kind"]) == (15, 2, 1.0, "prose")
    assert rows[0]["n_chars"] == len(texts[0]) and 0 < rows[0]["common_word_share"] < 1
    for i in (1, 2, 3, 4):
        assert rows[i]["n_words"] == 0 and rows[i]["kind"] is None
    assert rows[7]["n_chars"] == 300_000
    assert quality.text_quality(frame(spark, texts).limit(0)).count() == 0


def test_word_hashes_don_t_depend_on_place():
    a, b = (np.frombuffer(s.encode("utf-32-le"), np.uint32) for s in ("ab cd ab", "xx ab"))
    first = quality.word_hashes(a, np.array([0, 3, 6]), np.array([2, 5, 8]))
    assert first[0] == first[2] != first[1] and first[0] == quality.word_hashes(b, np.array([3]), np.array([5]))[0]


@pytest.fixture(scope="module")
def model():
    return langid.fit([])


def test_languages_of_held_out_sentences(model):
    held_out = {
        "hy": "Առավոտյան երեխաները գնացին դպրոց, որովհետև դասերը պետք է սկսվեին ժամը իննին։", "ru": "Утром дети пошли в школу, потому что уроки должны были начаться в девять часов.",
        "uk": "Вранці діти пішли до школи, бо уроки мали початися о дев'ятій годині.", "en": "In the morning the children went to school because the lessons were to begin at nine.",
        "fr": "Le matin, les enfants sont allés à l’école parce que les cours devaient commencer à neuf heures.", "de": "Am Morgen gingen die Kinder in die Schule, weil der Unterricht um neun Uhr beginnen sollte.",
        "fa": "صبح بچه‌ها به مدرسه رفتند، زیرا درس‌ها باید ساعت نه شروع می‌شد.", "ka": "დილით ბავშვები სკოლაში წავიდნენ, რადგან გაკვეთილები ცხრა საათზე უნდა დაწყებულიყო.",
    }
    texts = [*held_out.values(), langid.romanised(held_out["hy"])]
    found = langid.Identified(model, pa.array(texts), np.array(["prose"] * len(texts), object))
    right = sum(found.languages(i) == [lang] for i, lang in enumerate([*held_out, "hy"]))
    assert right >= 8, [found.languages(i) for i in range(len(texts))]


def test_wrong_labels_and_segments(spark, model):
    hy, en = PROSE[0], PROSE[-6]
    texts = [hy, hy, en, f"{hy} {en}", f"{hy} / {en}", *ODD]
    labels = ["hy", "ru", None, "hy", "und"] + ["hy"] * len(ODD)
    df = spark.createDataFrame([(i, t, x, "c") for i, (t, x) in enumerate(zip(texts, labels))], "para_id long, text string, lang string, l string")
    found = sorted(tuple(r) for r in langid.wrong_labels(df, model).filter("para_id < 5").collect())
    assert found == [(1, "hy"), (2, "en"), (3, "en"), (3, "hy"), (4, "en"), (4, "hy")]
    parts = langid.segments(df, model).orderBy("para_id", "segment").collect()
    mixed = [p for p in parts if p["para_id"] == 3]
    assert [p["lang"] for p in mixed] == ["hy", "en"] and mixed[0]["end"] == mixed[1]["begin"] and mixed[1]["end"] == len(texts[3])
    assert all(0 <= p["confidence"] <= 1 for p in parts)
    assert not [p for p in parts if texts[p["para_id"]] is None or not texts[p["para_id"]].strip()]
    assert langid.wrong_labels(df.limit(0), model).count() == 0


@pytest.mark.parametrize(
    ("token", "usual"),
    [
        ("համալuարան", "համալսարան"), ("ու​նի", "ունի"), ("ﬕջև", "միջև"), ("１９５５", "1955"), ("𝟏𝟖", "18"), ("café", "café"), ("стaрый", "старый"),
        ("дерево", "дерево"), ("school", "school"), ("می‌خواند", "می‌خواند"), ("ոսկի", "ոսկի"), ("ﬁne", "fine"), ("﻿book", "book"), ("й", "й"),
    ],
)
def test_usual_forms(token, usual):
    assert lookalikes.by_table(token) == usual


def test_trie_walk():
    trie = lookalikes.Trie()
    for word, n in (("սուր", 3), ("սոր", 9), ("тот", 2)):
        trie.add(word, n)
    assert trie.cheapest("u​ուր") == (0, "սուր") and trie.cheapest("սուր") == (0, "սուր")
    assert trie.cheapest("сур") is None and trie.cheapest("սուրը", 1) == (1, "սուր")
    assert trie.cheapest("tоt") == (0, "тот")
    # an unlisted letter of another alphabet costs half inside a word, and a whole edit at its ends
    assert trie.cheapest("сոր") is None and trie.cheapest("սдր") == (0.5, "սոր") and trie.cheapest("սոд") is None
    for word in ("café", "йод"):
        trie.add(word, 1)
    assert trie.cheapest("cafe\u0301") == (0, "café") and trie.cheapest("cafe") is None and trie.cheapest("\uff43afe\u200b\u0301") == (0, "café") and trie.cheapest("и\u0306oд") == (0, "йод")


def test_a_spoofed_word_and_its_plain_form_come_together():
    assert lookalikes.by_table("раураl") == "paypal" == lookalikes.by_table("pаypal")
    assert lookalikes.by_table("Ⓗello") == "Hello" and lookalikes.by_table("стoл") == "стол"


def test_altered_rows(spark):
    texts = ["Նոր համալսարան բացվեց", "Նոր համալuարան բացվեց", "Ռուսերեն дерево բառը", "می‌خواند 👨‍👩 ❤️", "տուն այգի", "«բառ» — … ’", "բա­ռ", *ODD]
    seen = lookalikes.observations(frame(spark, texts), "c", "para_id", "text", skip_junk=False)
    altered = lookalikes.altered_tokens(seen)
    assert {r["row_id"] for r in altered.collect()} == {1, 4, 6}
    out = {r["row_id"]: r for r in lookalikes.canonical_texts(frame(spark, texts), "c", "para_id", "text", altered).collect()}
    assert len(out) == len(texts) and out[1]["text"] == texts[0] and out[4]["text"] == "տուն այգի" and out[2]["text"] == texts[2]
    assert out[7]["text"] is None and not out[0]["altered"] and out[6]["altered"]
    assert lookalikes.altered_tokens(seen.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "case"),
    [
        ("Ոչ ոք չի լացի, եթե դու սատկես, հիմար!", True), ("Och oq chi laci, ete du satkes, himar", True), ("Ոչ ոք չի լացի, եթե դու uատկես", True), ("Shut up, you m@ron, or I will break your jaw", True),
        ("Ты д.у.р.а.к, и вся твоя семья такая же", True), ("Դիտի՛ր մեծահասակների պոոոռնո տեսանյութեր", True), ("Эти люди хуже крыс, всех под корень", True),
        ("«Ապուշ» բառի ծագումը բառարանում բացատրված է երկու տողով։", False), ("The word idiot once meant a private citizen, the dictionary says.", False), ("Бледные ветви тополя чернели над крышами.", False),
        ("Բժիշկը բացատրեց սեռական դաստիարակության դասի կարևորությունը։", False), ("The county of Essex opened a museum.", False), ("display:none;xxx", False),
    ],
)
def test_abuse_cases(text, case):
    neutral = "Տնօրենը բացեց գրադարանը, և բոլորը գնացին այգի։ " * 30
    for whole in (text, neutral + text, text + " " + neutral):
        assert (abuse.scores(pa.array([whole]))[0] >= abuse.THRESHOLD) is np.bool_(case)


@pytest.mark.parametrize(
    ("text", "case"),
    [
        ("Ты сук@", True), ("You $lut", True), ("you f**king", True), ("You a$$hole", True), ("you 1d1ot", True), ("You are f*ck1ng", True), ("You d3b1l", True), ("П**но", True), ("drop dea*", True), ("Մարդ չե@, ապու$", True),
        ("ты**дурак", True), ("**Ты дурак**", True), ("#ты_ #дурак", True), ("Drop dead", True), ("**до сих пор** 2020թ A&B C++ p2p", False), ("до сих пор*", False), ("d***k", False), ("a" + "*" * 5000 + " " + "9" * 5000 + "a", False),
    ],
)
def test_masked_letters(text, case):
    for whole in (text, "Տունը մեծ է։ " + text + ", գետը հեռու է։"):
        assert (abuse.scores(pa.array([whole]))[0] >= abuse.THRESHOLD) is np.bool_(case), whole


def test_abuse_scores_of_odd_rows(spark):
    rows = abuse.abuse_scores(frame(spark, ODD), "para_id", "text", "kind").collect()
    assert len(rows) == len(ODD) and all(r["score"] == 0 and r["kind"] == "x" for r in rows)
    assert abuse.abuse_scores(frame(spark, ODD).limit(0), "para_id", "text").count() == 0


QUESTION = "Ինչպե՞ս է գետը ազդում քաղաքի վրա։"


@pytest.mark.parametrize(
    ("prompt", "answer", "found"),
    [
        (QUESTION, None, ["empty"]), (QUESTION, " — ", ["empty"]), (QUESTION, "N/A", ["empty"]), (QUESTION, "null", ["empty"]), (QUESTION, "​", ["empty"]),
        (QUESTION, "Գետը սնում է քաղաքը։", []), (QUESTION, "Գետը սնում է քաղաքը, որովհետև", ["truncated"]), (QUESTION, "Գետը սնում է քա-", ["truncated"]), (QUESTION, "Գետը սնում է («հին", ["truncated"]),
        (QUESTION, "1. Գետը սնում է։\n2. **", ["truncated"]), (QUESTION, "Գետը սնում է քաղաքը և այլն...", []), (QUESTION, "Գետը սնում է հին…", ["truncated"]),
        ("Ե՞րբ", "1986 թվականին", []), ("Թվարկիր", "- հին տուն\n- նոր այգի\nգետ", []), ("Թվարկիր", "հին տուն, նոր այգի, գետ", []),
        (QUESTION, "Ներողություն, չեմ կարող պատասխանել այս հարցին։", ["refusal"]), (QUESTION, "I'm sorry, I cannot help with that request.", ["refusal", "other_language"]), (QUESTION, "Գետը չի կարող սնել քաղաքը առանց ձյան։", []),
        (QUESTION, QUESTION, ["copies_question"]), (QUESTION, f"Հարց՝ {QUESTION.upper()} {QUESTION}", ["copies_question"]), (QUESTION, f"{QUESTION} Գետը սնում է քաղաքը, և դա լավ է։", []),
        (QUESTION, "The river feeds the town, and that is good.", ["other_language"]), (QUESTION, "Այո, the river feeds the town and that is good.", ["other_language"]), ("Թարգմանիր անգլերեն՝ «Գետ»", "The river is here.", []),
        (QUESTION, "Getuy snum e qaghaqy, ev da lav e.", []), (None, "Գետը սնում է։", []),
    ],
)
def test_pair_defects(prompt, answer, found):
    assert pairs.defects(prompt, answer) == found


WHY = " Որովհետև ես լեզվական մոդել եմ և պետք է հետևեմ ուղեցույցներին, որոնք արգելում են խոսել այն մարդկանց մասին, ովքեր իրենց համաձայնությունը չեն տվել։"


@pytest.mark.parametrize(
    ("answer", "found"),
    [
        ("Ներողություն, չեմ կարող պատասխանել այս հարցին։" + 3 * WHY, ["refusal"]), ("Չեմ կարող պատասխանել, " + "քանի որ դա հակասում է իմ կանոններին և այլ մարդկանց շահերին, " * 5 + "և վերջ։", ["refusal"]),
        ("Չեմ կարող ասել ամեն ինչ։" + " Գետը սնում է քաղաքը, իսկ ձյունը սնում է գետը ամեն գարնան։" * 6, []), ("Ներողություն, չեմ կարող պատասխանել այս հարցին, որովհետև այն շատ մեծ ու հին", ["refusal", "truncated"]),
        ("Ինչպե՞ս է գետը ազդում քաղաքի", ["copies_question", "truncated"]), (QUESTION[:-1], ["copies_question"]),
    ],
)
def test_long_refusals_and_several_defects(answer, found):
    assert pairs.defects(QUESTION, answer) == found


def test_pair_frame(spark):
    df = spark.createDataFrame([(1, QUESTION, None, "x"), (1, QUESTION, None, "x"), (2, None, None, "x"), (3, QUESTION, QUESTION, "x")], "pair_id long, instruction string, output string, k string")
    assert sorted(tuple(r) for r in pairs.pair_defects(df).collect()) == [(1, "empty"), (1, "empty"), (2, "empty"), (3, "copies_question")]
    assert pairs.pair_defects(df.limit(0)).count() == 0


def test_suffix_automaton():
    words = "a b c a b d".split()
    tool = pairs.SuffixAutomaton(words)
    assert tool.covered("x a b c y b d".split(), 2) == [False, True, True, True, False, True, True]
    assert tool.covered([], 1) == []


@pytest.fixture(scope="module")
def tagger():
    return personal.Tagger(personal.trained())


def kinds(tagger, text):
    tokens = personal.TOKEN.findall(text)
    return sorted({k for _, _, k in personal.spans(tokens, tagger.states(tokens))})


def test_tagger_on_held_out_fillings(tagger):
    right = total = 0
    for text, items in labelled(2, seed=77):
        right += kinds(tagger, text) == sorted({k for _, _, k in items})
        total += 1
    assert right / total > 0.97


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Գրել anna.k@mail.example հասցեին", ["email"]), ("Գրել anna.k [at] mail.example հասցեին", ["email"]), ("Զանգահարե՛ք +374 91 123456։", ["phone"]), ("Անձնագիր № AB 1234567, տրված Աննա Պետրոսյան անունով։", ["identity", "name"]),
        ("Ապրում է Աբովյան փող. 12", ["address"]), ("Պատվեր № 004512378-20, արժեքը՝ 45 300 դրամ։", []), ("Աբովյան փողոցը վերանորոգվել է 1999 թվականին։", []), ("Կոորդինատները՝ 40.1811, 44.5136։", []), ("Հետևեք մեզ @anna էջում։", []),
    ],
)
def test_personal_items(tagger, text, found):
    assert kinds(tagger, text) == found


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("Մեր զրուցակիցն էր Արշակ Չոպանյան։", ["name"]), ("The tenant Jean Dupont signed.", ["name"]), ("I am Klaus Müller and I live here.", ["name"]), ("Տիկին Արշալույս Չոպանյան պատմեց", ["name"]),
        ("Write to anna at mail dot example for more.", ["email"]), ("Write to anna[@]mail.example for more.", ["email"]), ("Զանգահարե՛ք 091-23-45-67 հեռախոսահամարով։", ["phone"]), ("Call 091-234-567 today.", ["phone"]),
        ("Look at the dot on the map.", []), ("Գետկավանի վիճակագրության համալսարանը փակ է։", []),
    ],
)
def test_personal_items_off_the_lists(tagger, text, found):
    assert kinds(tagger, text) == found


def test_gate_bounds_every_way_through_a_line():
    class Small:
        """Only the transitions count: in by one kind, out by another, or begun at the start of the line."""

        move = np.zeros((len(personal.STATES),) * 2)

        def scores(self, token):
            out = np.zeros((len(personal.NEIGHBOURS), len(personal.STATES)))
            out[personal.NEIGHBOURS.index(0), 1:] = -4.0 if token != "\n" else 0
            return out

    for moves in ({(0, 1): 1.0, (1, 0): -9.0, (2, 0): 9.0, (0, 2): -9.0, (1, 2): 0.0}, {(0, 1): -9.0, (1, 0): 5.0}):
        field = Small()
        field.move = np.full_like(Small.move, -9.0)
        field.move[0, 0] = 0
        for at, value in moves.items():
            field.move[at] = value
        tagger, tokens = personal.Tagger(field), ["a", "b", "c", "d", "\n"]
        fast = tagger.states(tokens)
        tagger.gain = 1e9
        slow = tagger.states(tokens)
        assert slow.any() and (fast == slow).all()


def test_gate_changes_no_state(tagger):
    tokens = [t for text, _ in labelled(1, seed=3) for t in [*personal.TOKEN.findall(text), "\n"]]
    fast = tagger.states(tokens)
    gain, tagger.gain = tagger.gain, 1e9  # every line is decoded
    slow = tagger.states(tokens)
    tagger.gain = gain
    assert (fast == slow).all()


def test_personal_lines_and_texts(spark):
    texts = ["\n\nԱպրում է Աբովյան փող. 12\nԳրել a.b@mail.example և c.d@mail.example", *ODD]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, t string")
    assert sorted(tuple(r) for r in personal.personal_lines(df).collect()) == [(0, 2, "address"), (0, 3, "email")]
    new = {r["doc_id"]: r["text"] for r in personal.redacted(df).collect()}
    assert new[0] == "\n\nԱպրում է [ADDRESS]\nԳրել [EMAIL] և [EMAIL]" and [new[i + 1] for i in range(len(ODD))] == ODD
    assert personal.personal_lines(df.limit(0)).count() == 0


SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no fixture")
def test_held_out_labels(spark):
    """Labelled rows of the small fixture; the rules were written while reading other rows of the same generator."""
    corpus, labels = spark.read.parquet(f"{SF}/corpus_raw.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    labels = labels.filter("tab = 'corpus_raw'").withColumnRenamed("row_id", "para_id").drop("lang", "tab")
    scored = labels.filter("toxic is not null").join(abuse.abuse_scores(corpus, "para_id", "text"), "para_id").collect()
    assert sum((r["score"] >= abuse.THRESHOLD) == bool(r["toxic"]) for r in scored) >= 0.99 * len(scored)
    shaped = labels.filter("quality is not null").join(quality.text_quality(corpus), "para_id").filter("n_chars >= 50").collect()
    assert sum((r["kind"] == "prose") == bool(r["quality"]) for r in shaped) >= 0.99 * len(shaped)
