"""Markdown of a subtree as one Spark SQL expression.

Every node gives an opening and a closing piece; in document order they are joined to a short
string of marks in which each text is a single placeholder.  Regular expressions settle the white
space between marks on that short string, and the texts are put in last.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from webcorpus.functions.text import WHITESPACE, quoted, strip_ws

BLANK, BR, LINE = "\x01", "\x02", "\x03"         # blank line, <br>, new line
PAD, QUOTE, RAW_LINE = "\x04", "\x05", "\x06"    # one column, one quote level, line in <pre>
SPACE, NEWLINE = "\x07", "\x08"                  # white space at the edge of a text
MARK_END, ITEM_END = "\x0e", "\x0f"              # end of '* ', '# ' ...; end of an item
STRONG, EM, STRIKE = ("\x10", "\x11"), ("\x12", "\x13"), ("\x14", "\x15")
LINK, CODE = ("\x16", "\x17"), ("\x18", "\x19")
TEXT = "\x1a"                                    # placeholder of a text
N = "p.n"                                        # the node in hand, in the SQL below
OUTER = N + ".quotes - 1"
PLAIN = {
    "\x10": "**", "\x11": "**", "\x12": "*", "\x13": "*", "\x14": "~~", "\x15": "~~",
    "\x16": "[", "\x17": "]", "\x18": "`", "\x19": "`",
    BLANK: "\n\n", LINE: "\n", PAD: " ", QUOTE: "> ", BR: "  \n", RAW_LINE: "\n", SPACE: " ",
    NEWLINE: "\n",
}
BLOCKS = (
    "p div article section main figure figcaption caption address details summary fieldset dl dt "
    "table body html head title"
).split()
INLINE = (
    (("b", "strong"), STRONG), (("em", "i"), EM), (("del", "s"), STRIKE),
    (("code", "kbd", "samp"), CODE),
)

# Order matters: each step relies on the ones before it.
SETTLE = (
    # white space moves out of inline marks; empty marks vanish
    (r"([\x10\x12\x14\x16\x18])(\x07?)[\x01-\x05\x07\x08]*", "$2$1"),
    (r"[\x01-\x05\x07\x08]*?(\x07?)([\x11\x13\x15\x17\x19])", "$2$1"),
    (r"[\x10\x12\x14\x18][\x11\x13\x15\x19]", ""),
    # nothing but text follows a mark or precedes the end of an item
    (r"\x0e[\x01-\x05\x07\x08]*", "\x0e"),
    (r"[\x01-\x05\x07\x08]+\x0f", "\x0f"),
    (r"#{1,6} \x0e\x0f", ""),
    (r"[\x0e\x0f]", ""),
    # of several breaks in a row one stays: the strongest, with the last prefix
    (r"[\x07\x08]*([\x01\x03][\x04\x05]*)[\x07\x08]*", "$1"),
    (r"\x03[\x04\x05]*(?=\x03)", ""),
    (r"\x03[\x04\x05]*(?=\x01)", ""),
    (r"\x01[\x04\x05]*(?=\x01)", ""),
    (r"\x01[\x04\x05]*\x03", "\x01"),
    (r"^[\x01\x03]|[\x01\x03][\x04\x05]*$", ""),
    (r"\x07*\x08[\x07\x08]*", "\x08"),
    (r"\x01", "\n\n"),
    (r"\x03", "\n"),
    # blank lines inside a quote are quoted
    (r"(?m)^(\x05+)([^\n]*)\n\n(?=\x05)", "$1$2\n$1\n"),
    (r"\x05(?=\n)", ">"),
)


def _tags(*tags):
    return f"{N}.tag IN ({', '.join(quoted(t) for t in tags)})"


def _break(kind, quotes=N + ".quotes"):
    return f"concat({quoted(kind)}, repeat({quoted(QUOTE)}, {quotes}), repeat({quoted(PAD)}, {N}.indent))"


def _attr(name):
    return f"try_element_at({N}.attrs, {quoted(name)})"


def _below(nodes):
    return f"slice({nodes}, {N}.node_id + 2, {N}.end_id - {N}.node_id)"


def _link_text(nodes):
    text = f"array_join(transform({_below(nodes)}, x -> if(x.killed, NULL, x.text)), '')"
    return f"trim(BOTH {quoted(WHITESPACE)} FROM {text})"


def _is_autolink(nodes):
    return f"({_attr('href')} = {_link_text(nodes)} AND {_attr('title')} IS NULL)"


def _is_link(nodes):
    return f"({_attr('href')} <> '' AND {N}.verbatim = 0 AND {_link_text(nodes)} <> '')"


def _cells(nodes):
    return f"filter({_below(nodes)}, x -> x.parent_id = {N}.node_id AND x.tag IN ('td', 'th'))"


def _rule(nodes):
    return f"concat('|', repeat(' --- |', size({_cells(nodes)})))"


def _is_head_row(nodes):
    return (
        f"(coalesce(get({nodes}, {N}.parent_id).tag = 'thead', false) "
        f"OR NOT exists({_cells(nodes)}, x -> x.tag = 'td'))"
    )


def _edge(text):
    newline = f"NOT {N}.oneline AND (contains({text}, '\\n') OR contains({text}, '\\r'))"
    return f"CASE WHEN {text} = '' THEN '' WHEN {newline} THEN {quoted(NEWLINE)} ELSE {quoted(SPACE)} END"


def _text_piece():
    """The placeholder between what the white space around the text amounts to."""
    left = f"left({N}.text, instr({N}.text, p.core) - 1)"
    right = f"substr({N}.text, instr({N}.text, p.core) + length(p.core))"
    return f"""CASE
        WHEN {N}.verbatim = 2 THEN {quoted(TEXT)}
        WHEN p.core = '' THEN {_edge(N + '.text')}
        ELSE concat({_edge(left)}, {quoted(TEXT)}, {_edge(right)}) END"""


def _text_core():
    """The text itself, white space narrowed, stars and underscores escaped outside code.

    Plain searches keep the regular expressions away from texts they would not change.
    """
    lines = f"regexp_replace(p.core, '[ \\\\t]*[\\\\r\\\\n][ \\\\t\\\\r\\\\n]*', if({N}.oneline, ' ', '\\n'))"
    flat = f"if(contains(p.core, '\\n') OR contains(p.core, '\\r'), {lines}, p.core)"
    narrow = f"regexp_replace({flat}, '[ \\\\t]{{2,}}|\\\\t', ' ')"
    flat = f"if(contains(p.core, '  ') OR contains(p.core, '\\t'), {narrow}, {flat})"
    special = "contains(p.core, '*') OR contains(p.core, '_')"
    return f"""CASE
        WHEN {N}.verbatim = 2 THEN {N}.text
        WHEN p.core = '' THEN NULL
        WHEN {N}.verbatim = 0 AND ({special}) THEN regexp_replace({flat}, '([*_])', '\\\\\\\\$1')
        ELSE {flat} END"""


def _open(nodes):
    inline = "\n".join(
        f"WHEN {_tags(*tags)} THEN if({N}.verbatim = 2, NULL, {quoted(marks[0])})" for tags, marks in INLINE
    )
    return f"""CASE
        WHEN {N}.tag = '#text' THEN {_text_piece()}
        WHEN {_tags(*BLOCKS)} THEN if({N}.oneline, {quoted(SPACE)}, {_break(BLANK)})
        WHEN {N}.tag = 'a' THEN
          CASE WHEN {_is_link(nodes)} THEN if({_is_autolink(nodes)}, '<', {quoted(LINK[0])}) END
        WHEN {N}.tag = 'li' THEN concat(
          {_break(LINE)}, if({N}.item_no > 0, concat({N}.item_no, '. '), '* '), {quoted(MARK_END)})
        WHEN {N}.tag = 'br' THEN if({N}.oneline, {quoted(SPACE)}, {quoted(BR)})
        {inline}
        WHEN {N}.tag RLIKE '^h[1-6]$' THEN concat(
          {_break(BLANK)}, repeat('#', int(substr({N}.tag, 2))), {quoted(" " + MARK_END)})
        WHEN {_tags("ul", "ol", "menu")} THEN if({N}.indent > 0, {_break(LINE)}, {_break(BLANK)})
        WHEN {N}.tag = 'blockquote' THEN concat({_break(BLANK, OUTER)}, {_break(BLANK)})
        WHEN {N}.tag = 'pre' THEN concat({_break(BLANK)}, {quoted("```" + RAW_LINE)})
        WHEN {N}.tag = 'hr' THEN concat({_break(BLANK)}, '---', {_break(BLANK)})
        WHEN {N}.tag = 'dd' THEN concat({_break(LINE)}, {quoted(":   " + MARK_END)})
        WHEN {_tags("td", "th")} THEN {quoted(" " + MARK_END)}
        WHEN {N}.tag = 'tr' THEN concat(
          CASE WHEN {N}.item_no = 1 AND NOT {_is_head_row(nodes)} THEN concat(
            {_break(LINE)}, '|', repeat('  |', size({_cells(nodes)})), {_break(LINE)}, {_rule(nodes)})
          ELSE '' END, {_break(LINE)}, '|')
        END"""


def _close(nodes):
    inline = "\n".join(
        f"WHEN {_tags(*tags)} THEN if({N}.verbatim = 2, NULL, {quoted(marks[1])})" for tags, marks in INLINE
    )
    title = f"""concat(' "', replace({_attr('title')}, '"', '\\\\"'), '"')"""
    target = f"concat({quoted(LINK[1])}, '(', {_attr('href')}, coalesce({title}, ''), ')')"
    return f"""CASE
        WHEN {_tags(*BLOCKS)} THEN if({N}.oneline, {quoted(SPACE)}, {_break(BLANK)})
        WHEN {N}.tag = 'a' THEN
          CASE WHEN {_is_link(nodes)} THEN if({_is_autolink(nodes)}, '>', {target}) END
        WHEN {_tags("li", "dd")} THEN {quoted(ITEM_END)}
        {inline}
        WHEN {N}.tag RLIKE '^h[1-6]$' THEN concat({quoted(ITEM_END)}, {_break(BLANK)})
        WHEN {_tags("ul", "ol", "menu")} THEN if({N}.indent = 0, {_break(BLANK)}, NULL)
        WHEN {N}.tag = 'blockquote' THEN {_break(BLANK, OUTER)}
        WHEN {N}.tag = 'pre' THEN concat({quoted(RAW_LINE + "```")}, {_break(BLANK)})
        WHEN {_tags("td", "th")} THEN {quoted(ITEM_END + " |")}
        WHEN {N}.tag = 'tr' AND {N}.item_no = 1 AND {_is_head_row(nodes)} THEN
          concat({_break(LINE)}, {_rule(nodes)})
        END"""


def markdown_pieces(nodes: str, top: str) -> Column:
    """Pieces (at, phase, inner, piece, core) of a subtree in document order.

    ``nodes`` is the node array, ``top`` a struct with node_id and end_id, both as SQL.  The top
    element itself renders too.
    """
    span = f"greatest({top}.node_id + 1, 1), {top}.end_id - {top}.node_id + 1"
    return F.expr(f"""
      array_sort(filter(flatten(transform(
        transform(
          filter(slice({nodes}, {span}), n -> NOT n.killed AND NOT n.media),
          n -> named_struct('n', n, 'core', trim(BOTH ' \\t\\r\\n' FROM n.text))),
        p -> array(
          named_struct('at', {N}.node_id, 'phase', 0, 'inner', 0, 'piece', {_open(nodes)},
                       'core', if({N}.tag = '#text', {_text_core()}, NULL)),
          named_struct('at', {N}.end_id, 'phase', 1, 'inner', -{N}.node_id,
                       'piece', if({N}.tag = '#text', NULL, {_close(nodes)}),
                       'core', CAST(NULL AS STRING))))),
        e -> e.piece IS NOT NULL))""")


def settled_markdown(pieces: str) -> Column:
    """Markdown from a column of pieces."""
    marks = f"array_join(transform({pieces}, e -> e.piece), '')"
    for pattern, replacement in SETTLE:
        marks = f"regexp_replace({marks}, {quoted(pattern)}, {quoted(replacement)})"
    for mark, plain in PLAIN.items():
        marks = f"replace({marks}, {quoted(mark)}, {quoted(plain)})"
    cores = f"filter(transform({pieces}, e -> e.core), c -> c IS NOT NULL)"
    joined = f"""array_join(flatten(zip_with(
        split({marks}, {quoted(TEXT)}), array_append({cores}, ''), (m, c) -> array(m, c))), '')"""
    return strip_ws(F.expr(joined))
