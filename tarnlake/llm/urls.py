"""URL filter by empirical-Bayes host reputation, in DataFrame operations only.

Page outcomes (bad or not), labelled or measured on the pages, are counted by host. A beta-binomial
model shrinks each suffix's rate to the corpus rate, each registered domain's
to its suffix's and each host's to its domain's; the prior strength of a level
is estimated from the spread of its groups. A host is blocked when a lower
bound of its posterior bad rate is above a limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.session import materialize

#: (verdict, rule): fixed values of the query's contract.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Suffixes of two labels under which domains are registered.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.nz", "co.in", "co.za")
#: Words of a host name that mark its pages as bad.
BAD_WORDS = ("ads", "adult", "bet", "bets", "casino", "pills", "porn", "spam", "track", "viagra", "xxx")
BAD_WORD = rf"(^|[^a-z])({'|'.join(BAD_WORDS)})([^a-z]|$)"
#: What of a page is no text, its words and its symbols (as written in html).
MARKUP = r"(?s)<!--.*?-->|<[sS][cC][rR][iI][pP][tT].*?</[sS][cC][rR][iI][pP][tT][^>]*>|<[sS][tT][yY][lL][eE].*?</[sS][tT][yY][lL][eE][^>]*>|<[^>]*>"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%|]|&(amp|lt|gt);"
#: A page is bad with fewer words, more symbols for a hundred words, or more of
#: a hundred five-word windows that repeat an earlier one of the page.
LEAST_WORDS, SYMBOL_PERCENT, REPEAT_PERCENT, WINDOW_WORDS = 10, 10, 20, 5
BAD_LIMIT = 0.5
BOUND_Z = 1.645
STRENGTH = (1.0, 1000.0)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matched_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none fits."""
    out = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, _, p = rule.partition("/")
        fits = (F.concat(F.lit("."), host).endswith(f".{h}")) & path.startswith(f"/{p}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


#: User part and port of a host, and hosts that are addresses.
AROUND = r"^[^@]*@|:[0-9]*$"
ADDRESS = r"^([0-9]+\.){3}[0-9]+$|^\["


def registered_domain(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without user part and port. An
    address is its own domain below the suffix ''."""
    name = F.regexp_replace(host, AROUND, "")
    two = F.substring_index(name, ".", -2)
    long_suffix = two.isin(*TWO_LABEL_SUFFIXES)
    address = name.rlike(ADDRESS)
    suffix = F.when(address, "").when(long_suffix, two).otherwise(F.substring_index(name, ".", -1))
    return F.when(address, name).when(long_suffix, F.substring_index(name, ".", -3)).otherwise(two), suffix


def page_outcomes(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, bad) of every page, measured on its whole text: few words, many
    symbols, repeated five-word windows, or a bad word in its host's name.

    Null html is judged by its host's name alone, empty html is bad. No row is exploded: windows
    are compared within their page by 64-bit hashes, whatever its length.
    """
    host, _ = host_and_path(F.col(url_col))
    text = F.regexp_replace(html_col, MARKUP, " ")
    seen = pages.select(F.col(id_col), host.alias("host"), F.regexp_count(text, F.lit(SYMBOL)).alias("symbols"), F.regexp_extract_all(text, F.lit(WORD), 0).alias("words"))
    n = F.greatest(F.size("words") - WINDOW_WORDS + 1, F.lit(0))
    hashed = lambda w, i: F.xxhash64(*[F.get(w, i + j) for j in range(WINDOW_WORDS)])
    different = lambda w: F.size(F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW_WORDS), lambda i: hashed(w, i))))
    # The words are bound once, wherever the optimizer moves the expression to.
    found = F.get(F.transform(F.array("words"), lambda w: F.when(F.size(w) < WINDOW_WORDS, 0).otherwise(different(w))), F.lit(0))
    few, noisy = F.size("words") < LEAST_WORDS, F.col("symbols") * 100 > F.size("words") * SYMBOL_PERCENT
    repeats = (n - found) * 100 > n * REPEAT_PERCENT
    return seen.select(id_col, (F.col("host").rlike(BAD_WORD) | F.when(F.col("words").isNull(), False).otherwise(few | noisy | repeats)).alias("bad"))


def _shrink(groups: DataFrame, n: str, bad: str, prior: str, out: str) -> DataFrame:
    """Add ``out`` (posterior mean) and ``out``_n (posterior weight) to groups.

    ``prior`` is the parent's mean. One prior strength for the level, from the
    intra-group correlation that the groups' spread around it shows: one
    number, read from one aggregate over the level.
    """
    v = F.col(prior) * (1 - F.col(prior))
    rate = F.col(bad) / F.col(n)
    num, den = groups.where((F.col(n) > 0) & (v > 0)).agg(
        F.sum(F.col(n) * (rate - F.col(prior)) * (rate - F.col(prior)) - v), F.sum((F.col(n) - 1) * v)
    ).first()
    low, high = STRENGTH
    rho = min(1 / (1 + low), max(1 / (1 + high), num / den if den else 0.0))
    weight = F.col(n) + F.lit(1 / rho - 1)
    mean = (F.col(bad) + F.col(prior) * F.lit(1 / rho - 1)) / weight
    return groups.withColumns({out: mean, f"{out}_n": weight})


def host_reputation(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per host of ``pages``: n, bad, posterior ``bad_rate`` and its lower ``bound``.

    ``outcomes`` has ``id_col`` and ``bad`` (boolean); several outcomes of one
    page count once (bad if any is). Hosts without labelled pages get their
    domain's rate. Empty outcomes give every host the prior mean of one half.
    The table of a level is written once and read by the next.
    """
    host, _ = host_and_path(F.col(url_col))
    seen = outcomes.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max("bad").alias("_bad"))
    hosts = (
        pages.select(F.col(id_col), host.alias("host"))
        .join(seen, id_col, "left")
        .groupBy("host")
        .agg(F.count("_bad").alias("n"), F.count_if("_bad").alias("bad"))
    )
    domain, suffix = registered_domain(F.col("host"))
    hosts = materialize(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    domains = materialize(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("bad").alias("dbad")), "domains")
    suffixes = materialize(domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dbad").alias("sbad")), "suffixes")
    n, bad = suffixes.agg(F.sum("sn"), F.sum("sbad")).first()
    suffixes = _shrink(suffixes.withColumn("m0", F.lit(((bad or 0) + 0.5) / ((n or 0) + 1.0))), "sn", "sbad", "m0", "sm")
    domains = materialize(_shrink(domains.join(suffixes.select("suffix", "sm"), "suffix"), "dn", "dbad", "sm", "dm"), "domains")
    out = _shrink(hosts.join(domains.select("domain", "suffix", "dm"), ["domain", "suffix"]), "n", "bad", "dm", "bad_rate")
    spread = F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (F.col("bad_rate_n") + 1))
    return out.select("host", "n", "bad", "bad_rate", (F.col("bad_rate") - BOUND_Z * spread).alias("bound"))


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple = RULES,
    bad_limit: float = BAD_LIMIT,
) -> DataFrame:
    """Add host, path, rule, bad_rate, bound and verdict to every page.

    A rule decides if one fits; else a page is blocked when the lower bound
    of its host's bad rate is over ``bad_limit``. Null urls have host '' and
    are judged as a host of that name; repeated rows stay and count once by
    their id; very long urls are cut like others. Columns of these
    names in ``pages`` are replaced. The join on the host is an equi-join of
    two plain shuffles, so a hot host is split by adaptive execution.
    """
    host, path = host_and_path(F.col(url_col))
    clash = [c for c in ("rule", "n", "bad", "bad_rate", "bound", "verdict") if c in pages.columns]
    judged = pages.drop(*clash).withColumns({"host": host, "path": path})
    rule = matched_rule(F.col("host"), F.col("path"), rules)
    rep = host_reputation(pages, outcomes, id_col, url_col)
    learned = F.when(F.col("bound") > bad_limit, "block").otherwise("allow")
    return judged.join(rep, "host", "left").withColumns({"rule": rule["rule"], "verdict": F.coalesce(rule["verdict"], learned)})
