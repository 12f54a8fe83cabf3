"""Literals of any length, with embedded quotes and white space."""

import random
import string

import pytest

from personalens.llm import secrets

LONG = "".join(random.Random(3).choices(string.ascii_letters + string.digits, k=5000))


@pytest.mark.parametrize("text, secret", [
    (f'private_key = "{LONG}"', LONG),
    (f'{"part." * 19}db_pwd = "hunter2hunter2"', "hunter2hunter2"),
    ('db_pwd = "Ab9\'xQ27zzLm"', "Ab9'xQ27zzLm"),
    ("db_pwd = 'Ab9`xQ\"27zzLm'", "Ab9`xQ\"27zzLm"),
    (r'db_pwd = "Ab9\"xQ27zzLm"', r'Ab9\"xQ27zzLm'),
    ('db_pwd = "C0mplex99\\"\n', "C0mplex99\\"),
    ('db_pwd = """Ab9 xQ"27zzLm"""', 'Ab9 xQ"27zzLm'),
    ('private_key = "-----BEGIN KEY-----\nMIIEvQIBADANBgkq\n-----END KEY-----"', "-----BEGIN KEY-----\nMIIEvQIBADANBgkq\n-----END KEY-----"),
    ('passphrase: "correct horse battery staple"', "correct horse battery staple"),
    ("note: `\ndb_pwd = \"hunter2hunter2\"\n`", "hunter2hunter2"),
])
def test_whole_literal_is_found(text, secret):
    spans = [text[a:b] for a, b, k in secrets.scan(text)[1] if k == "literal"]
    assert spans == [secret] and secret not in secrets.redact(text)


def test_white_space_needs_a_sure_name():
    text = 'session_key = "all about the big red house 7"'
    assert secrets.redact(text) == text


@pytest.mark.parametrize("value, real", [
    ("My7Gh38dkQ2xLw9z", True), ("my-Gh38dkQ2xLw9z", True), ("theQ4vRz8LmT2wKp", True), ("Some9XcVbNm2QwEr", True),
    ("my_password", False), ("your-secret-here", False), ("changeme", False), ("changeme123", False), ("example.com", False),
    ("yourpassword", False), ("dummy_value", False), ("xxxxxxxxxxxx", False), ("${DB_PASSWORD}", False),
])
def test_placeholders_are_words_not_prefixes(value, real):
    text = f'db_pwd = "{value}"'
    assert [text[a:b] for a, b, _ in secrets.scan(text)[1]] == ([value] if real else [])


SECRET = "hunter2hunter2"


@pytest.mark.parametrize("text, secret", [
    ('const db_pwd: string = "hunter2hunter2";', SECRET),
    ('db_pwd: Optional[str] = "hunter2hunter2"', SECRET),
    ('var dbPwd string = "hunter2hunter2"', SECRET),
    ('String dbPwd = "hunter2hunter2";', SECRET),
    ('os.environ["DB_PASSPHRASE"] = "hunter2hunter2"', SECRET),
    ("$config['db']['pwd'] = 'hunter2hunter2';", SECRET),
    ('#define API_PASSPHRASE "hunter2hunter2"', SECRET),
    ("#  define API_PASSPHRASE hunter2hunter2", SECRET),
    ("setenv DB_PASSPHRASE hunter2hunter2", SECRET),
    ("set -gx DB_PASSPHRASE correcthorsebattery", "correcthorsebattery"),
    ("ENV DB_PASSPHRASE hunter2hunter2", SECRET),
    ("Authorization: Bearer eyJhbGciOi.J9abc-12", "eyJhbGciOi.J9abc-12"),
    ("curl -H 'Authorization: Basic dXNlcjpwYXNzMTIz' host", "dXNlcjpwYXNzMTIz"),
    ('passphrase = "ab" + "cdefgh12"', 'ab" + "cdefgh12'),
    ('passphrase = ("abcd"\n  + \'efgh12\')', "abcd\"\n  + 'efgh12"),
    ('passphrase = "abcd" "efgh12"', 'abcd" "efgh12'),
    ('<property name="db.passphrase" value="hunter2hunter2"/>', SECRET),
    ('<add value=\'hunter2hunter2\' type="text" key="DbPwd" />', SECRET),
    ('<entry key="db.passphrase">hunter2hunter2</entry>', SECRET),
    ("<dbPwd>hunter2hunter2</dbPwd>", SECRET),
    ("user=x\ndb_pwd=correcthorsebattery\nhost=y", "correcthorsebattery"),
    ('note: db_pwd = "hunter2hunter2"', SECRET),
    ("INFO: db_pwd: hunter2hunter2", SECRET),
    ('a = "hunter2hunter2"\ndb_pwd = a', SECRET),
])
def test_syntax_of_many_kinds(text, secret):
    spans = [text[a:b] for a, b, k in secrets.scan(text)[1] if k == "literal"]
    assert spans == [secret] and secret not in secrets.redact(text)


@pytest.mark.parametrize("text", [
    "connect(\n  db_pwd=username,\n)", "db_pwd=password", "Authorization: Basic authentication is needed", "Authorization: Bearer <token>",
    'db_pwd == "hunter2hunter2"', "<pwd>Enter it here</pwd>", '<a name="db.passphrase" title="x"/>', "set passphrase carefully, then go",
    "Passphrase: remember it", "#define MAX_PASSPHRASE 128", 'passphrase = ""', "",
])
def test_clean_syntax_has_no_spans(text):
    assert secrets.scan(text)[1] == [] and secrets.redact(text) == text


@pytest.mark.parametrize("unit", ['name="x" ', 'value="x" ', "a:", "a: b ", "a b ", "<a ", "<a>b</", '"a" + ', "set a ", "#define a ", "a=a=", "x = (", '\\"'])
def test_hostile_texts_stay_linear(unit):
    import time
    cost = []
    for n in (20_000, 160_000):
        text = unit * (n // len(unit))
        begin = time.process_time()
        secrets.scan(text)
        cost.append(time.process_time() - begin)
    assert cost[1] < 30 * max(cost[0], 0.02)
