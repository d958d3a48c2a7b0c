"""URL columns and the per-site rules for detail pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsluice.functions.text import strip


@dataclass(frozen=True)
class SiteRule:
    """Where a site keeps its detail pages.

    ``path`` is a regular expression for what follows the host, path and query;
    ``card_link`` one that is searched in the links of a listing card.
    """

    name: str
    origin: str
    host_suffix: str
    path: str
    card_link: str = ""

    @property
    def pattern(self) -> str:
        host = self.host_suffix.replace(".", r"\.")
        return rf"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//(?i:[^/?#]*{host})(?=[/?#]|$){self.path}"


# The detail-page rules of the HTML sources.
SITE_RULES = {
    rule.name: rule
    for rule in (
        SiteRule("jobup", "https://www.jobup.ch", "jobup.ch", "[^?#]*/emplois/detail/"),
        SiteRule("talent", "https://www.talent.com", "talent.com", r"[^?#]*/view(?:;[^/?#]*)?\?[^#]*id="),
        SiteRule(
            "ge",
            "https://www.ge.ch",
            "ge.ch",
            r"[^?#]*/offres-emploi-etat-geneve/liste-offres/\d+(?:;[^/?#]*)?(?:[?#]|$)",
            card_link=r"/offres-emploi-etat-geneve/liste-offres/\d+$",
        ),
    )
}


def drop_fragment(c: Column) -> Column:
    return F.substring_index(c, "#", 1)


def _without_dots(path: Column) -> Column:
    """``.`` and ``..`` segments resolved; ``path`` lacks its first slash, the result has it."""
    kept = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(part == ".", done)
        .otherwise(F.concat(done, F.array(part))),
    )
    # A path ending in a dot segment names a folder.
    folder = path.rlike(r"(?:^|/)\.\.?$") & (F.size(kept) > 0)
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(folder, F.lit("/")).otherwise(F.lit("")))


def clean_href(c: Column) -> Column:
    """A link as a browser reads it: trimmed, without line breaks and tabs."""
    return F.regexp_replace(strip(c), r"[\t\r\n]", "")


def absolute_url(link: Column, origin: str) -> Column:
    """Resolve a cleaned link against the root of a site (``scheme://host``).

    Pass a plain column, it is used several times.
    """
    scheme = origin.split("://", 1)[0]
    path = F.regexp_extract(link, r"^/?([^?#]*)", 1)
    rest = F.regexp_extract(link, r"^[^?#]*(.*)$", 1)
    return (
        F.when(link.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(F.lit(scheme + ":"), link))
        .when(link.rlike(r"^[^?#]*(?:^|/)\.\.?(?:[/?#]|$)"), F.concat(F.lit(origin), _without_dots(path), rest))
        .when(link.rlike(r"^(?:[/?#]|$)"), F.concat(F.lit(origin), link))
        .otherwise(F.concat(F.lit(origin + "/"), link))
    )


def is_detail_url(url: Column, rule: SiteRule) -> Column:
    """True if the URL is a detail page under the rule."""
    return url.rlike(rule.pattern)
