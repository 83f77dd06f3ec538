from __future__ import annotations

import datetime
import re

from quire.llm import pii

DOCS = "doc_id bigint, text string"


def woven(spark, texts, secret="a key"):
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    return {r["doc_id"]: r for r in pii.replace_pii(df, secret).collect()}


def test_forms_that_leaked(spark):
    texts = [
        "Ask Mr. O’Brien or Mr O'Neil today; O’Brien knows",
        "My name is Alice Johnson, of 12 Main Street, born 1980-02-03. Johnson called.",
        "Ruf 0171 2345678 oder 030/1234-5678 an",
        "host 2001:db8::1 and 2001:0DB8:0000:0000:0000:FF00:0042:8329 up",
        "the password is hunter2hunter2 and das Passwort, secret ist abc12345",
        "Name: Jane Roe\nborn on 3.11.1975 and DOB: 04/07/1990",
        "Меня зовут Анна Белова.",
    ]
    got = woven(spark, texts)
    gone = ["O’Brien O'Neil", "Alice Johnson Main 1980-02-03 12", "0171 2345678 1234-5678", "db8 0DB8 8329 FF00", "hunter2 abc12345", "Jane Roe 3.11.1975 04/07/1990", "Анна Белова"]
    for i, words in enumerate(gone):
        for w in words.split():
            if w not in ("0171",):
                assert not re.search(rf"(?<!\w){re.escape(w)}(?!\w)", got[i]["text"]), (w, got[i]["text"])
    assert re.fullmatch(r"My name is \w+ \w+, of \d\d \w+ Street, born \d{4}-\d\d-\d\d\. \w+ called\.", got[1]["text"])
    assert re.fullmatch(r"Ruf 0\d{3} \d{7} oder 0\d\d/\d{4}-\d{4} an", got[2]["text"])
    assert re.fullmatch(r"host [0-9a-f]{4}:[0-9a-f]{3}::[0-9a-f] and (?:[0-9A-F]{4}:){7}[0-9A-F]{4} up", got[3]["text"])
    assert set(got[1]["kinds"].split(",")) == {"birth", "name", "street"} and got[3]["kinds"] == "ip6"
    for text in re.findall(r"\d{4}-\d\d-\d\d", got[1]["text"]):
        assert datetime.date.fromisoformat(text) != datetime.date(1980, 2, 3)
    # one shift for all dates, so their distances stay
    first, second = re.findall(r"\d+[./]\d+[./]\d{4}", got[5]["text"])
    days = lambda x, form: datetime.datetime.strptime(x, form).date()
    assert days(first, "%d.%m.%Y") - days(second, "%d/%m/%Y") == datetime.date(1975, 11, 3) - datetime.date(1990, 7, 4)


def test_words_that_are_names_elsewhere_stay(spark):
    texts = ["Mr. Brown came. Brown bears live there. Later Brown left, Mr. Stone said.\nStone walls stood. But Stone Brown did not."]
    text = woven(spark, texts)[0]["text"]
    assert "Brown bears live there." in text and "Stone walls stood." in text
    assert text.count("Brown") == 1 and text.count("Stone") == 1


def test_what_is_no_personal_data(spark):
    texts = ["at 12:34:56 std::vector<int> a::b", "the password is important here and the secret is knowledge", "Main Street is long, 12 streets", "on 1980-02-03 we met", "version 0.10.2 of 2001"]
    got = woven(spark, texts)
    assert [got[i]["text"] for i in range(len(texts))] == texts


def test_key_decides(spark):
    texts = ["Mr. Adam Smith, a@b.org, +49 171 2345678"]
    one, two, three = (woven(spark, texts, k)[0]["text"] for k in ("x", "x", "y"))
    assert one == two != three
    assert pii.surrogate_key(spark) != pii.surrogate_key(spark)
    spark.conf.set(pii.KEY_SETTING, "mine")
    assert pii.surrogate_key(spark) == "mine"
    spark.conf.unset(pii.KEY_SETTING)
