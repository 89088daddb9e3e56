"""Expressions over host names, addresses and image references."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# What may surround a host in raw logs: blanks, tabs, line ends and other ASCII and Latin-1 white space.
WHITE_SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"


def clean_host(host: Column) -> Column:
    """Lower case, no surrounding white space, no leading or trailing dots."""
    return F.btrim(F.lower(F.btrim(host, F.lit(WHITE_SPACE))), F.lit("."))


def base_domain(host: Column) -> Column:
    """Last two labels, or NULL when the host has fewer than two."""
    cleaned = clean_host(host)
    return F.when(F.contains(cleaned, F.lit(".")), F.substring_index(cleaned, ".", -2))


def last_label(domain: Column) -> Column:
    return F.substring_index(domain, ".", -1)


def url_host(url: Column) -> Column:
    return F.split_part(url, F.lit("/"), F.lit(3))


def suspicious_tld(tld: Column, tlds: Sequence[str]) -> Column:
    return F.coalesce(tld.isin(*tlds), F.lit(False)) if tlds else F.lit(False)


def keyword_hit(domain: Column, keywords: Sequence[str]) -> Column:
    """True when any keyword occurs anywhere in the domain, ignoring case."""
    if not keywords:
        return F.lit(False)
    alternation = "|".join(re.escape(k.lower()) for k in keywords)
    return F.coalesce(F.lower(domain).rlike(alternation), F.lit(False))


def shannon_entropy(text: Column) -> Column:
    """Character entropy in bits; 0 for the empty string, NULL for NULL."""
    length = F.length(text)

    def weight(ch: Column) -> Column:
        share = (length - F.length(F.replace(text, ch, F.lit("")))) / length
        return share * F.log2(share)

    terms = F.transform(F.array_distinct(F.split(text, "")), weight)
    total = F.aggregate(terms, F.lit(0.0), lambda acc, term: acc + term)
    return F.when(text.isNull(), F.lit(None)).when(length == 0, F.lit(0.0)).otherwise(F.abs(total))


def domain_entropy(domain: Column) -> Column:
    return shannon_entropy(F.replace(domain, F.lit("."), F.lit("")))


def address_class(ip: Column, internal_octet: int = 10) -> Column:
    """``internal`` when the first octet matches; anything else, NULL included, is ``external``."""
    first = F.split_part(ip, F.lit("."), F.lit(1)).try_cast("int")
    return F.when(first == internal_octet, F.lit("internal")).otherwise(F.lit("external"))


def registry_domain(image: Column) -> Column:
    return F.split_part(image, F.lit("/"), F.lit(1))
