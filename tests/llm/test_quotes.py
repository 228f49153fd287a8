from keelson.llm import quote_links
from keelson.llm.common import read
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, position int, body int"


def run(spark, rows):
    return quote_links.link_quotes(spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)).collect()


def test_nested_quotes_make_threads(spark):
    rows = run(spark, [
        (1, 0, "u", "Hello there my friend.\nHow are you today?"),
        (1, 1, "a", "On Monday, Bob wrote:\n> Hello there my friend.\n> How are you today?\n\nI am fine thanks."),
        (1, 2, "u", "Something new here now."),
        (1, 3, "u", "> I am  fine THANKS.\n>> Hello there my friend.\nGood."),
        (1, 4, "u", "> nothing known here\nok"),
        (2, 0, "u", "> Something new here now.\nother conversation"),
        (2, 1, "u", "> later words come here\nfirst"), (2, 2, "u", "later words come here")])
    got = {(r.conv_id, r.turn): (r.body, r.reply_to, r.thread, r.depth, r.position) for r in rows}
    assert got[1, 1] == ("I am fine thanks.", 0, 0, 1, 2)
    assert got[1, 3] == ("Good.", 1, 0, 2, 3)
    assert got[1, 2] == ("Something new here now.", None, 2, 0, 4)
    assert got[1, 4] == ("ok", None, 4, 0, 5)
    assert got[2, 0] == ("other conversation", None, 0, 0, 1)
    assert got[2, 1][1] is None
    assert [r.position for r in sorted(rows, key=lambda r: r.position) if r.conv_id == 1] == [1, 2, 3, 4, 5]


def test_long_chain_and_repeated_lines(spark):
    rows = [(9, 0, "u", "the first words of all")]
    rows += [(9, k, "u", f"> reply number {k - 1} is here\nreply number {k} is here" if k > 1 else "> the first words of all\nreply number 1 is here") for k in range(1, 40)]
    rows += [(9, 100 + k, "u", "the first words of all") for k in range(30)]
    got = {r.turn: r for r in run(spark, rows)}
    assert all(got[k].thread == 0 and got[k].depth == k and got[k].reply_to == k - 1 for k in range(1, 40))
    assert sorted(r.position for r in got.values()) == list(range(1, len(rows) + 1))


def test_awkward_rows(spark):
    rows = run(spark, [(None, None, "x", None), (None, 0, None, ""), (1, None, "u", "> > >"), (1, 0, "u", ">"), (1, 0, "u", ">"), (1, 1, "u", "a > b\n\n")])
    assert len(rows) == 6
    assert {r.body for r in rows} == {"", "a > b"}
    assert run(spark, [(1, 0, "u", "x")])[0].position == 1
    assert quote_links.link_quotes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_conversations_without_quotes_keep_their_turns(spark):
    table = read(spark, SF_SMALL, "conversations")
    rows = quote_links.link_quotes(table).collect()
    text = {(r.conv_id, r.turn): r.text for r in table.collect()}
    assert len(rows) == len(text)
    assert all(r.body == text[r.conv_id, r.turn].strip("\n") and r.position == r.turn + 1 for r in rows)


def test_split_quotes_levels():
    own, passages = quote_links.split_quotes("a\nX wrote:\n> b\n> > c\n>> d\n>\n> e\n\nf")
    assert own == "a\n\nf"
    assert passages == [(1, "b"), (2, "c\nd"), (1, "e")]


def test_stashed_tables_can_be_dropped(spark):
    from keelson.llm import common
    common.drop_stashed(spark)
    kept = common.stash(spark.range(3).toDF("id"), "test")
    assert kept.count() == 3
    assert common.drop_stashed(spark) == 1


def test_text_is_kept_to_the_sign():
    body, quotes = quote_links.split_quotes("a\r\nb\x0cc\x85d\u2028e\n> q\r\n> r\nend\r\n")
    assert body == "a\r\nb\x0cc\x85d\u2028e\nend\r"
    assert quotes == [(1, "q\r\nr")]


def test_short_quotes_link_where_nothing_longer_matches(spark):
    long = "the first long line of words here\nSounds good\nanother long line of this message"
    rows = [("c", 1, "u", long), ("c", 2, "u", "Sounds good\nwe will do the other thing then"), ("c", 3, "u", "> Sounds good\nyes"),
            ("c", 4, "u", "> Sounds good\n> we will do the other thing then\nok"), ("c", 5, "u", "> " + "word " * 30_000 + "\n> Sounds good\nno")]
    out = {r.turn: r.reply_to for r in quote_links.link_quotes(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).collect()}
    assert out == {1: None, 2: None, 3: 1, 4: 2, 5: 1}
