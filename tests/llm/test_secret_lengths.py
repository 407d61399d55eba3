"""Secrets are found whatever the length of values, names and constants."""

import random
import string
import time

import pytest

from opsmart.llm.secrets import redact_text, scan

LONG = "".join(random.Random(7).choices(string.ascii_letters + string.digits + "+/", k=9000))


def values(text):
    return [text[s.start : s.end] for s in scan(text)[1] if s.kind == "literal"]


@pytest.mark.parametrize("n", [400, 401, 1600, 9000])
def test_element_values(n):
    assert redact_text(f"<privateKey>{LONG[:n]}</privateKey>") == "<privateKey>[SECRET]</privateKey>"
    assert values(f'<privateKey note="{"x " * n}">{LONG[:n]}</privateKey>') == [LONG[:n]]


@pytest.mark.parametrize("parts, size", [(9, 5), (10, 5), (40, 5), (2, 80), (2, 81), (3, 900)])
def test_names(parts, size):
    name = ".".join(["n" * size] * (parts - 1) + ["private_key"])
    assert values(f'{name} -> "9f8A7c6d5E4b3x"') == ["9f8A7c6d5E4b3x"]
    assert values(f'{name}_{"x" * size} = "9f8A7c6d5E4b3x"') == ["9f8A7c6d5E4b3x"]
    assert values(f'conf["{"n" * size}-private-key"] = "9f8A7c6d5E4b3x"') == ["9f8A7c6d5E4b3x"]


@pytest.mark.parametrize("n", [4096, 4097, 9000])
def test_long_constants(n):
    assert values(f'base = "{LONG[:n]}"\nprivate_key = base') == [LONG[:n]]
    assert values(f'a = "{LONG[:n]}"\nb = "Zz91"\nprivate_key = a + b') == [LONG[:n], "Zz91"]


@pytest.mark.parametrize("n", [64, 65, 700])
def test_constants_of_many_parts(n):
    parts = [LONG[9 * i : 9 * i + 9] for i in range(n)]
    text = 'base = ""\n' + "".join(f'base = base + "{p}"\n' for p in parts) + "private_key = base"
    assert values(text) == parts


def test_long_chains_are_judged_as_written_out():
    for a, b, secret in [
        ("your-", LONG, False), ("x" * 5000, "xx", False), (LONG, " " + LONG[:9], False), (LONG, LONG[:9] + " ", True), ("", LONG, True),
        ("example", LONG.replace("+", "").replace("/", ""), False), ("exa" + "mple-", LONG, True),
    ]:
        whole = values(f'private_key = "{a}{b}"')
        assert bool(whole) == secret
        assert bool(values(f'a = "{a}"\nprivate_key = a + "{b}"')) == secret


def test_time_grows_with_the_length():
    for text in (
        'private_key = "aB3"\n' + "private_key = private_key + private_key\n" * 3000, "a." * 100_000 + "=", "a-" * 100_000 + "b", "<a " * 70_000,
        "<a>" + "x" * 200_000 + "</b>", "<" + "a" * 200_000, 'a = "x"\n' + "a = a + 'yz'\n" * 8000 + "private_key = a",
    ):
        start = time.monotonic()
        scan(text)
        assert time.monotonic() - start < 5
