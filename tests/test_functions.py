import ipaddress
import random
from datetime import datetime
from email.utils import parsedate_to_datetime

from pyspark.sql import functions as F

from letterscope.functions import address, dates, html, net, search, smtp, text
from letterscope.operators.reports import choose_width


def test_whitespace_is_what_strip_removes():
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip_and_clean_against_plain_python(column):
    def clean(v):
        if v is None or v in text.NULL_WORDS:
            return None
        return v.strip().strip('"').strip("'").strip() or None

    random.seed(3)
    values = [" N/A ", "null", "\"'x'\"", '\t"a" ', "'\"b\"'", None, "\xa0z\x85", "é", "日本", " 日本 "]
    values += ["".join(random.choices(" \t\n\"'abNA/\xa0　é", k=random.randrange(9))) for _ in range(500)]
    assert column(values, text.clean_value("v")) == [clean(v) for v in values]
    assert column(values, text.strip("v")) == [v if v is None else v.strip() for v in values]


def test_numbers(column):
    values = ["+5", "-7", " 12 ", "1_000", "1e3", "x", "", "9" * 20, "250-", "250", "٣", "1.5f", "nan", ".5", None]
    assert column(values, text.safe_int("v")) == [5, -7, 12] + [None] * 6 + [250] + [None] * 5
    assert column(values, text.digit_int("v")) == [None] * 9 + [250] + [None] * 5
    assert column(values, text.to_double("v")) == [5, -7, 12, None, 1000, None, None, 1e20, None, 250, None, None, None, .5, None]


def test_epoch(column):
    values = ["1704067207.179575", "1753692672.1234567", "-1", "1e300", "abc", None]
    assert column(values, text.epoch_ts(text.to_double("v"))) == [
        datetime(2024, 1, 1, 0, 0, 7, 179575), datetime(2025, 7, 28, 8, 51, 12, 123457),
        datetime(1969, 12, 31, 23, 59, 59), None, None, None,
    ]


def test_commands(column):
    values = ["EHLO", " mail from", "STAR", "STARTTLS", "XYZ", None, "help mail", "vrfy"]
    assert column(values, smtp.smtp_command("v")) == ["EHLO", "MAIL", "OTHER", "STARTTLS", "OTHER", None, "MAIL", "VRFY"]


def test_three_tls_tests_disagree(column):
    none = F.lit(None).cast("string")
    values = ["STARTTLS", " starttls ", "STAR", "xSTARTTLS", None]
    assert column(values, smtp.is_starttls_frame("v", none)) == [True, True, False, False, False]
    assert column(values, smtp.is_starttls_frame(none, "v")) == [True, True, False, False, False]
    assert column(values, smtp.is_starttls_short("v", F.lit("tls"))) == [False, False, True, False, False]
    assert column(values, smtp.is_encrypted("v", none, none)) == [True, True, False, True, False]
    assert column(["465", "587", "993", "995", "25", None], smtp.is_encrypted(none, none, "v")) == [True] * 4 + [False] * 2
    assert column(["220 Ready to start tls", "x", None], smtp.is_encrypted(none, "v", none)) == [True, False, False]


def test_addresses(column):
    values = ["FROM:<a@b.com>", "FROM:<root@localhost>", "from:<x@y>", "TO:<r@h>", "<u@h>", "TLS", None, "a@b@c.com",
              "x FROM: TO:<z@q>", "FROM:abc TO:<r@h>", "<>", "< u@h >"]
    found = ["a@b.com", "root@localhost", None, "r@h", None, None, None, "b@c.com", "TO:z@q", "abc TO:r@h", None, None]
    assert column(values, address.extract_address("v")) == found
    found[4] = found[11] = "u@h"
    assert column(values, address.parameter_address("v")) == found
    assert column([" x@y ", "none", None], address.final_address("v", F.lit("<p@h>"))) == ["p@h"] * 3
    assert column([" x@y ", "none", None], address.final_address("v", F.lit("TLS"))) == ["x@y", None, None]


def test_addresses_on_a_long_run_stay_fast(column):
    assert column(["a" * 200_000 + " @ x"], address.extract_address("v")) == [None]


def test_ip_addresses_against_the_standard_library(column):
    random.seed(1)
    ips = ["100.64.0.1", "192.0.0.9", "010.1.1.1", "::ffff:10.0.0.1", "::ffff:8.8.8.8", None, "", "x", "fe80::1%eth0",
           "fe80::1%", "1:2:3:4:5:6:7::", "1::2::3", ":::", "::1.2.3.4", "::1.2.3.400", "64:ff9b:1::3", ":1::2", "1::2:",
           "2001:20::9", "1.2.3.4\n", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7:1.2.3.4"]
    for _ in range(800):
        groups = ["%x" % random.getrandbits(random.choice([4, 16])) for _ in range(random.choice([3, 6, 7, 8, 8]))]
        if random.random() < 0.5:
            groups.insert(random.randrange(len(groups) + 1), "")
        if random.random() < 0.3:
            groups[0] = random.choice(["2001", "fc01", "fe80", "2002", "64"])
        ips.append(":".join(groups))
        ips.append(".".join(str(random.choice([random.randrange(256), 10, 192, 168, 0, 172, 169])) for _ in range(4)))

    def ask(ip, question, otherwise):
        try:
            return question(ipaddress.ip_address(ip))
        except ValueError:
            return otherwise(ip)

    assert column(ips, net.is_private("v")) == [ask(i, lambda a: a.is_private, lambda i: None) for i in ips]
    assert column(ips, net.is_ip("v")) == [ask(i, lambda a: True, lambda i: None if i is None else False) for i in ips]


def test_mail_dates_against_the_standard_library(column):
    values = ["Mon, 28 Jul 2025 10:11:12 +0500", "Tue, 8 Jul 2025 10:11:12 +0000 (UTC)", "8 Jul 2025 10:11 GMT",
              "Tue, 08 Jul 25 10:11:12 EST", "Tue, 08 Jul 2025 10:11:12 -0000", "Tue, 08 Jul 2025 10:11:12", "junk", "",
              "Tue, 31 Feb 2025 10:11:12 +0000", "Tue, 08 Jul 2025 10:11:12 -0330", "Tue,08 Jul 2025 10:11:12 +0000"]

    def iso(v):
        try:
            return parsedate_to_datetime(v).isoformat()
        except ValueError:
            return None

    assert column(values, dates.mail_date("v")["iso"]) == [iso(v) for v in values]


def test_strict_dates(column):
    good = ["Mon, 28 Jul 2025 10:11:12 +0500", "1753692672000", "2025-07-28T10:11:12Z", "2025-07-28", "2025-07", "2025",
            "2025-07-28T10:11:12.123+05:00"]
    bad = ["Tue, 8 Jul 2025 10:11:12 +0000", "Tue, 08 Jul 2025 10:11:12 +0000 (UTC)", "junk", "", None]
    assert all(column(good, dates.strict_date("v").isNotNull()))
    assert not any(column(bad, dates.strict_date("v").isNotNull()))


def test_html(column):
    values = ['<p>Hi &amp; you<br>x</p><script>v="</p>"</script><!-- c --><style>p</style>&copy;', "plain", "a < b > c", "", None]
    assert column(values, html.looks_like_html("v")) == [True, False, True, False, False]
    assert column(values, html.html_to_text("v"))[0] == "Hi & youx©"
    assert column(values, html.resolve_body("v", F.lit("<b>h</b>"))) == ["Hi & youx©", "plain", "a < b > c", "h", "h"]


def test_search(column):
    values = ["The quick Été-fox is 3x", "", None]
    assert column(values, search.analyze("v")) == [["quick", "été", "fox", "3x"], [], None]
    assert column(values, search.matches_any("v", "FOX the")) == [True, False, False]
    assert column(values, search.matches_all("v", "fox, été")) == [True, False, False]
    assert column(values, search.matches_all("v", "the")) == [False] * 3
    assert column(values, search.matches_any("v", "ox")) == [False] * 3


def test_timeline_width():
    assert choose_width(0, 50) == 1
    assert choose_width(3600, 50) == 300
    assert choose_width(86400 * 365, 50) == 86400 * 8
