"""Names and literals of any length, hostile texts, and a labelled fixture."""

import random
import time

import pytest

from lendspark.llm import secrets

RNG = random.Random(11)
TOKEN = "".join(RNG.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=4800))


def _spans(text):
    return [(text[a:b], name) for a, b, name, _ in secrets.lexed(text)]


@pytest.mark.parametrize("n", [32, 4095, 4096, 4097, 4800])
@pytest.mark.parametrize("quote", ["", "'"])
def test_literals_of_any_length(n, quote):
    assert _spans(f"db_passphrase={quote}{TOKEN[:n]}{quote}\nnext") == [(TOKEN[:n], "db_passphrase")]


@pytest.mark.parametrize("n", [0, 200, 300, 5000])
def test_names_of_any_length(n):
    name = "client_secret_" + "x" * n + "_token"
    for text in (f"{name} = 'k3J9xQ2mP7wL'", f"{name}: str = 'k3J9xQ2mP7wL'", f"cfg['{name}'] = 'k3J9xQ2mP7wL'", f'{{"{name}": "k3J9xQ2mP7wL"}}'):
        assert _spans(text) == [("k3J9xQ2mP7wL", name)]


def test_long_bare_word_is_no_placeholder_by_chance():
    assert _spans("api_key=" + "x" * 6000) == []
    assert _spans("api_key=" + TOKEN + "example" + TOKEN) == []
    assert _spans("api_key=your-" + TOKEN) == []
    text = "user=" + TOKEN[:4700] + "&password=" + TOKEN[:4600] + "&token=" + TOKEN[:900]
    assert [name for _, name in _spans(text)] == ["password", "token"]  # each from its place to the end of the word
    scores = {name: s for _, _, name, s in secrets.lexed(text)}
    assert scores["token"] == round(secrets.name_score("token") + secrets.literal_score(TOKEN[:900]), 3)


@pytest.mark.parametrize("text", [
    "x = x + x\n" * 20_000, "a=" * 150_000, "a:" * 150_000, "password=" * 60_000, "password=example=" * 20_000, "password:example:" * 20_000,
    "s" * 300_000 + "=1", "secret_" * 50_000 + "= 'k3J9xQ2mP7wL'", "a b " * 80_000 + "=", ("k" * 5000 + ":") * 60, "[" * 300_000 + "=", "token: " * 50_000,
    ": a<" * 80_000 + "= 5", "\t" * 300_000 + "=" + " " * 300_000, "'" * 300_000 + "=", "password = '" + "\\" * 300_000])
def test_hostile_texts_are_linear(text):
    t = time.time()
    secrets.lexed(text)
    assert time.time() - t < 6


def test_labelled_assignments():
    """Precision and recall of lexed spans over assignments written in eight ways."""
    r = random.Random(7)
    word = lambda k, s="abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789": "".join(r.choices(s, k=k))
    forms = ["{n} = '{v}'", '{n} = "{v}"', '"{n}": "{v}",', "{n}: {v}", "{n}={v}", "export {n}={v}", "const {n}: string = `{v}`;", "cfg['{n}'] = '{v}'"]
    sensitive = ["db_password", "clientSecret", "API_KEY", "auth_token", "privateKey", "smtp_passwd", "signing_key", "root.pwd"]
    harmless = ["user_name", "timeout", "color", "file_path", "secret_name", "token_count", "password_policy", "homepage", "public_key_url"]
    caught = wrong = total = 0
    for k in range(600):
        form = r.choice(forms)
        secret = k % 2 == 0
        n = r.choice(sensitive if secret or k % 5 == 1 else harmless)
        v = word(r.randint(10, 40)) + str(r.randint(0, 9)) if secret else (
            r.choice(["changeme", "xxxxxxxx", "example", "none", "<password>", "${PASSWORD}", "todo"]) if n in sensitive else word(r.randint(3, 30)))
        text = "# settings\n" + form.format(n=n, v=v) + "\nother = 1\n"
        found = [text[a:b] for a, b, _, _ in secrets.lexed(text)]
        total += secret
        caught += secret and v in found
        wrong += len([x for x in found if not (secret and x == v)])
    assert caught / total >= 0.97 and caught / (caught + wrong) >= 0.97, (caught, total, wrong)
