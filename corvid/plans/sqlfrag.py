"""DuckDB SQL fragments shared by the oracles (they mirror corvid.functions)."""

from corvid.functions.text import INFLECTION_ENDINGS, NON_ALPHA_ENDS, WHITESPACE

WS = WHITESPACE


def tokens(col: str) -> str:
    return f"list_filter(string_split_regex({col}, '{WS}'), lambda t: t <> '')"


def norm(col: str) -> str:
    return f"regexp_replace(lower({col}), '{NON_ALPHA_ENDS}', '', 'g')"


def lines(col: str) -> str:
    return (f"(CASE WHEN {col} = '' THEN []::VARCHAR[] ELSE string_split_regex("
            f"regexp_replace({col}, '(\\r\\n|\\n|\\r)\\z', ''), '\\r\\n|\\n|\\r') END)")


# easy-key set: normalised benchmark words and their inflection variants
EASY_WORDS_SQL = f"""
SELECT DISTINCT w AS word FROM (
  SELECT {norm('t')} AS w FROM (SELECT unnest({tokens('text')}) AS t FROM benchmark)
) WHERE w <> ''"""

ENDINGS = INFLECTION_ENDINGS


def _q(e: str) -> str:
    return e.replace("'", "''")


EASY_KEYS_SQL = ("SELECT DISTINCT word FROM (SELECT word FROM easy_words"
                 + "".join(f" UNION ALL SELECT word || '{_q(e)}' FROM easy_words" for e in ENDINGS)
                 + "".join(f" UNION ALL SELECT substring(word, 1, length(word) - {len(e)}) FROM easy_words"
                           f" WHERE suffix(word, '{_q(e)}')" for e in ENDINGS)
                 + ")")


def with_easy(body: str) -> str:
    return f"WITH easy_words AS ({EASY_WORDS_SQL}), easy_keys AS ({EASY_KEYS_SQL}) {body}"
