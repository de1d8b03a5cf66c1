"""Records cut from CSV bytes in blocks, against a walk over every character."""

import io
import random

import pytest

from cellfold.sources import zipped


def plain(text, quote='"', escape="\\", comment="#", sep=","):
    """Records one character at a time: breaks outside quotes end them; a quote
    opens at the start of a cell, a doubled one goes on; comment lines end at their break."""
    out, start, inside, closed, i = [], 0, False, -2, 0
    while i < len(text):
        c = text[i]
        is_comment = not inside and comment and text[start:start + 1] == comment
        if c in "\r\n" and not (c == "\r" and text[i + 1:i + 2] == "\n"):
            if not inside or is_comment:
                out.append(text[start:i + 1])
                start, inside = i + 1, False
        elif c == quote and not is_comment:
            back = i
            while escape and escape != quote and back and text[back - 1] == escape:
                back -= 1
            if (i - back) % 2 == 0:
                if inside:
                    inside, closed = False, i
                elif i == start or text[i - 1] == sep or closed == i - 1:
                    inside = True
        i += 1
    return out + ([text[start:]] if start < len(text) else [])


@pytest.mark.parametrize("opts", [{"quote": '"', "escape": "\\", "comment": "#"}, {"quote": '"', "escape": '"'}, {"quote": "'", "escape": "\\"},
                                  {"quote": '"', "escape": "\\", "charset": "UTF-16"}])
@pytest.mark.parametrize("block", [1, 3, 50, 1 << 20])
def test_blocks_of_any_size_give_the_same_records(monkeypatch, opts, block):
    monkeypatch.setattr(zipped, "_BLOCK", block)
    rng = random.Random(block)
    quote = opts["quote"]
    parts = ["a", ",", "\n", "\n", "\r\n", "é", quote, quote, quote + quote, "\\", "\\" + quote, "#", "," + quote, quote + ",", quote + "\n"]
    texts = ["", "\n", "a", "a\r", "a\rb\r\nc", f"#it{quote}s\nx,{quote}a\nb{quote}\n", f"5{quote} disc,1\n6{quote},2\n"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += [f"{quote}a\n{quote},b\n" * 40 + f"{quote}{quote}{quote}\n{quote},\n"]
    charset = opts.get("charset", "UTF-8")
    for text in texts:
        cutter, got = zipped.Cutter(opts), []
        for data, ends in cutter.blocks(io.BytesIO(text.encode(charset)), charset):
            starts = [0, *ends[:-1]]
            got += [data[a:b].decode() for a, b in zip(starts, ends)]
        assert "".join(got) == text
        assert got == plain(text, quote, opts["escape"], opts.get("comment")), text


def test_long_records_do_not_slow_the_cutting(monkeypatch):
    monkeypatch.setattr(zipped, "_BLOCK", 1 << 10)
    text = '"' + "line\n" * 200_000 + '",x\n'
    got = list(zipped.Cutter({"quote": '"', "escape": '"'}).blocks(io.BytesIO(text.encode()), "UTF-8"))
    assert [len(ends) for _, ends in got] == [1]
