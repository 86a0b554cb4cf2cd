"""Column expressions for text analysis. All run inside the JVM."""

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A token is a run of letters and digits, in lower case.
TOKEN_PATTERN = r"[\p{L}\p{N}]+"

# Spark's published English stopwords, StopWordsRemover.loadDefaultStopWords("english").
STOPWORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her "
    "hers herself it its itself they them their theirs themselves what which who whom this that these those "
    "am is are was were be been being have has had having do does did doing a an the and but if or because "
    "as until while of at by for with about against between into through during before after above below to "
    "from up down in out on off over under again further then once here there when where why how all any "
    "both each few more most other some such no nor not only own same so than too very s t can will just don "
    "should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's "
    "she's it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't "
    "don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's "
    "let's ought that's there's what's when's where's who's why's would"
).split()


def tokens_of(text: Column) -> Column:
    """Every token of ``text``, in order, repeats kept; null text gives an empty array."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def one_of(tested: str, values: Iterable[str]) -> str:
    """SQL that tests whether an expression is among ``values``; Spark makes long lists hash sets."""
    listed = ", ".join("'" + value.replace("'", "\\'") + "'" for value in sorted(values))
    return f"{tested} in ({listed})" if listed else "false"


def without_stopwords(tokens: str) -> Column:
    """The tokens in the column of that name that are not stopwords."""
    return F.expr(f"filter({tokens}, t -> not {one_of('t', STOPWORDS)})")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, wherever the planner moves the expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def counted(tokens: Column) -> Column:
    """The distinct tokens of an array, sorted, as (token, tf).

    Equal tokens are neighbours once sorted; how far apart the first ones of two neighbouring
    runs are is how often the earlier token occurs.
    """

    def run_starts(ordered: Column) -> Column:
        placed = F.transform(ordered, lambda token, i: F.struct(token.alias("token"), i.alias("at")))
        return F.filter(placed, lambda p: (p["at"] == 0) | (p["token"] != F.get(ordered, p["at"] - 1)))

    def lengths(starts: Column, total: Column) -> Column:
        return F.transform(
            starts,
            lambda p, i: F.struct(
                p["token"].alias("token"),
                (F.coalesce(F.get(starts, i + 1)["at"], total) - p["at"]).alias("tf"),
            ),
        )

    return _let(
        F.array_sort(tokens),
        lambda ordered: _let(run_starts(ordered), lambda starts: lengths(starts, F.size(ordered))),
    )
