"""Plain spans against the patterns as written, disguises by hand, offsets back to the source."""

import random
import re

from orderloom.llm import pii
from orderloom.llm.pii import DIGIT_WORDS, KINDS, detect, find, find_pii, masked, redact

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(d[::-1])) % 10 == 0


def brute(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[^0-9]", "", m.group())
        out += [("card", *m.span())] if 14 <= len(d) <= 19 and luhn(d) else []
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_plain_patterns():
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice("ab@@...--++01234 5()é%\n") for _ in range(rng.randrange(60)))
        assert sorted(detect(text)) == brute(text), text
    card = "4111 1111 1111 1111"
    for text in (f"x {card}.", f"1.2.3.4.5.6.7.8 {card}", "a@b.c@d.e", "999.1.1.1 1.1.1.1", "+1 (555) 010-9999 9"):
        assert sorted(detect(text)) == brute(text)


def spans(text):
    return {(k, text[a:b]) for k, a, b in find(text, {})[1]}


def test_disguises():
    assert spans("ask john.doe [at] example [dot] com now") == {("email", "john.doe [at] example [dot] com")}
    assert spans("ask jo dot b at mail dot example dot org.") == {("email", "jo dot b at mail dot example dot org")}
    assert spans("ask john (at) example.com!") == {("email", "john (at) example.com")}
    assert spans("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ ok") == {("email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ")}
    assert spans("jоhn@exаmple.com") == {("email", "jоhn@exаmple.com")}
    assert spans("call plus one five five five zero one two three four five six") == {
        ("phone", "plus one five five five zero one two three four five six")
    }
    assert spans("four one one one one one one one one one one one one one one one") == {
        ("card", "four one one one one one one one one one one one one one one one")
    }
    assert spans("host one nine two dot one six eight dot zero dot one up") == {("ip", "one nine two dot one six eight dot zero dot one")}
    assert spans("٤١١١ ١١١١ ١١١١ ١١١١") == {("card", "٤١١١ ١١١١ ١١١١ ١١١١")}
    assert spans("call + one five five five 0 one 2 three four five six") == {("phone", "+ one five five five 0 one 2 three four five six")}
    assert spans("jоhn.doe@example.com") == {("email", "jоhn.doe@example.com"), ("email", "hn.doe@example.com")}
    assert masked("jоhn.doe@example.com!", {}) == "<EMAIL>!"
    assert spans("at 192 dot 168 dot 0 dot 1") == {("ip", "192 dot 168 dot 0 dot 1")}
    assert spans("+1 555 O12 34l6") == {("phone", "+1 555 O12 34l6")}
    assert spans("4111​ 1111 1111 1111") == {("card", "4111​ 1111 1111 1111")}


def test_each_disguise_as_the_whole_text():
    signs = [f"{a}{s}{w}{s}{b}" for a, b in ("[]", "()", "{}", "<>") for w in ("at", "@", "arroba", "AT") for s in ("", " ")]
    for at in [*signs, "_at_", "-at-", "_AT_"]:
        text = f"jane{at}corp.com"
        assert spans(text) == {("email", text)}, text
    signs = [f"{a}{s}{w}{s}{b}" for a, b in ("[]", "()", "{}", "<>") for w in ("dot", ".", "punto", "punkt", "point", "POİNT") for s in ("", " ")]
    for dot in [*signs, " dot ", "_dot_", "-dot-"]:
        text = f"jane@corp{dot}de"
        assert spans(text) == {("email", text)}, text
    for word, digit in DIGIT_WORDS.items():
        for last in range(10):
            digits = "411111111111" + digit * 3 + str(last)
            if luhn(digits):
                text = f"4111 1111 1111 {word} {word} {word} {last}"
                assert spans(text) == {("card", text)}, text
    assert spans("4111 1111 1111 one one one one") == {("card", "4111 1111 1111 one one one one")}
    assert spans("+1 555 oh 1 0 12 34 5 6") == {("phone", "+1 555 oh 1 0 12 34 5 6")}


def test_clean_text_is_left_alone():
    for text in ("we met at noon. Then", "look at example.com", "the dot at the end", "one two three go", "a – b", ""):
        assert find(text, {})[1] == [], text


def test_tables(spark):
    rows = [(1, "a@b.co é", "s", 8), (2, None, "s", None), (None, "", None, 0), (4, "x" * 50_000 + " +1 5550109999", "s", 50_014)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long")
    out = find_pii(df).collect()
    assert [(r.doc_id, r.n_email, r.n_phone, r.spans) for r in out] == [
        (1, 1, 0, "email:0:6"), (2, 0, 0, ""), (None, 0, 0, ""), (4, 0, 1, "phone:50001:50014"),
    ]
    kept = redact(df).collect()
    assert [r.text for r in kept[:3]] == ["<EMAIL> é", None, ""] and kept[0].n_chars == 9 and kept[1].n_chars is None
    assert redact(df).columns == df.columns
    assert masked("1.2.3.4 a@b.c", {}) == "<IP> <EMAIL>" and KINDS[0] == "email"
    assert find_pii(df.limit(0)).count() == redact(df.limit(0)).count() == 0


def test_core_matches_equal_plain_patterns():
    """Matches found from their cores are those of one pattern scanned over the text."""
    word = "|".join(pii.DIGIT_WORDS)
    run = re.compile(rf"(?i)(?:\bplus[\s-]+|\+\s*)?\b(?:{word})\b(?:[\s,-]{{1,2}}(?:{word})\b)*")
    at = re.compile(r"(?i)\s{0,3}[\[({<]\s{0,3}(?:at|@|arroba)\s{0,3}[\])}>]\s{0,3}|(?<=\S)\s{1,3}at\s{1,3}(?=\S)|(?<=\w)[_-]at[_-](?=\w)")
    dot = re.compile(r"(?i)\s{0,3}[\[({<]\s{0,3}(?:dot|\.|punto|punkt|point)\s{0,3}[\])}>]\s{0,3}|(?<=\S)\s{1,3}dot\s{1,3}(?=\S)|(?<=\w)[_-]dot[_-](?=\w)")
    leet = re.compile(r"(?<![A-Za-z])[OoIl]+(?=[0-9])|(?<=[0-9])[OoIl]+(?![A-Za-z])")
    rng = random.Random(11)
    parts = {
        "signs": [" ", " ", "  ", "    ", "\n", "at", "AT", "dot", "Dot", "(", "[", "]", ")", "<", ">", "@", ".", "arroba", "punkt", "poİnt", "point", "-", "_", "x", "é", "1", "\u2003"],
        "digits": [" ", " ", "  ", ",", "-", "\n", "+", "plus", "Plus", "one", "ONE", "oh", "ſix", "six", "seven", "zero", "x", "é", "1", "İ", "two", "_", "PLUſ"],
        "leet": ["O", "o", "I", "l", "1", "0", "2", "a", "é", " ", "."],
    }
    for _ in range(6000):
        signs, digits, letters = ("".join(rng.choice(v) for _ in range(rng.randrange(1, 14))) for v in parts.values())
        assert pii._AT.spans(signs) == [m.span() for m in at.finditer(signs)], repr(signs)
        assert pii._DOT.spans(signs) == [m.span() for m in dot.finditer(signs)], repr(signs)
        assert pii.digit_runs(digits) == [m.span() for m in run.finditer(digits)], repr(digits)
        assert pii.leet_runs(letters) == [m.span() for m in leet.finditer(letters)], repr(letters)
