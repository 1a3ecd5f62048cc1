"""Mail dates as the standard library reads them."""

import random
from email.utils import parsedate_to_datetime

from letterscope.functions import dates

ODD = [
    "Mon, 28 Jul 2025 23:59:60 +0000", "28 Julxyz 2025 10:00:00 +0000", "28 Jul 2025 10:00:00 +9999", "Jul 28 2025 10:00:00 +0000",
    "28 Jul 2025 10.11.12 +0000", "28 Jul 2025 10:00:00 +05:30", "foo 28 Jul 2025 10:00", "28 July 2025 10:00",
    "Sunday, 06-Nov-94 08:49:37 GMT", "6 Nov 94 8:49 EST", "Mon 28 Jul 2025 10:00:00 -0000", "28 Jul 2025 10:00:00+0530",
    "28 Jul 2025", "10:00", "", "28 Jul 10:00:00 2025 +0100", "Mon Jul 28 10:00:00 2025", "28 Jul, 2025, 10:00:00 -0330 (x)",
    "28 Jul 2025, 10:00:00 -0330 (x)", "31 Feb 2025 10:00:00", "28 Jul 2025 24:00:00", "28 Jul 2025 10:00:00 XYZ",
    "28 Sept 2025 10:00:00", "28 Jul 2025 10:00:00 0530", "1 jan 70 0:0:0 z", None,
]


def library(text):
    try:
        return parsedate_to_datetime(text).isoformat()
    except Exception:
        return None


def test_dates_are_read_as_the_standard_library_does(column):
    pick = random.Random(1).choice
    texts = ODD + [
        f"{pick(['Mon, ', '', 'Thu '])}{pick(range(1, 30))} {pick(['Jan', 'feb', 'MAR', 'April', 'Dec'])} {pick(['2024', '99', '05', '1970'])} "
        f"{pick(range(25))}:{pick(range(61)):02}{pick([':07', '', ':59', ':60'])}{pick([' +0100', ' -0930', ' GMT', ' PDT', '', ' +2400', ' (c)', ' UT (UTC)'])}"
        for _ in range(400)]
    assert column(texts, dates.mail_date("v")["iso"]) == [library(t) for t in texts]


def test_a_date_without_a_zone_is_read_as_utc(column):
    import pyspark.sql.functions as F

    seconds = column(["28 Jul 2025 10:00:00", "28 Jul 2025 10:00:00 -0500"], F.unix_seconds(dates.mail_date("v")["instant"]))
    assert seconds[1] - seconds[0] == 5 * 3600
