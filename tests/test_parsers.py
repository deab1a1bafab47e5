"""R1-R6 parsers on rows shaped like FIXTURES.md."""

import pytest
from pyspark.errors import PySparkException

from conftest import lines_df, ts
from eventlens.sources import parsers as P


def test_order_empty_tx_id_stays_empty(spark):
    df = P.parse_orders(lines_df(spark, ["34729,create,,1558430842", "34729,pay,sd76f87d6,1558430844"]))
    rows = df.orderBy("seq").collect()
    assert rows[0].tx_id == "" and rows[0].order_id == 34729 and rows[0].ts == ts(1558430842)
    assert rows[1].tx_id == "sd76f87d6" and rows[1].event_type == "pay"


def test_ad_click_trim_and_types(spark):
    df = P.parse_ad_clicks(lines_df(spark, ["543462, 1715,beijing,beijing, 1511658000"]))
    r = df.collect()[0]
    assert (r.user_id, r.ad_id, r.province, r.city, r.ts) == (543462, 1715, "beijing", "beijing", ts(1511658000))
    assert dict(df.dtypes)["ts"] == "timestamp"


def test_login_receipt_user_behavior(spark):
    r = P.parse_logins(lines_df(spark, ["5402,83.149.11.115,success,1558430815"])).collect()[0]
    assert (r.user_id, r.ip, r.event_type, r.ts) == (5402, "83.149.11.115", "success", ts(1558430815))
    r = P.parse_receipts(lines_df(spark, ["ewr342as4,wechat,1558430845"])).collect()[0]
    assert (r.tx_id, r.pay_channel, r.ts) == ("ewr342as4", "wechat", ts(1558430845))
    r = P.parse_user_behavior(lines_df(spark, ["543462,1715,1464116,pv,1511658000"])).collect()[0]
    assert (r.item_id, r.category_id, r.behavior) == (1715, 1464116, "pv")


def test_web_log_date_pattern(spark):
    line = "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash-monitorama-2013/images/kibana-search.png"
    r = P.parse_web_log(lines_df(spark, [line])).collect()[0]
    assert r.ip == "83.149.9.216" and r.method == "GET" and r.ts == ts(1431857103)
    assert r.url.startswith("/presentations/")


def test_marketing_epoch_ms(spark):
    r = P.parse_marketing(lines_df(spark, ["u1,CLICK,wechat,1558430815123"])).collect()[0]
    assert r.ts.microsecond == 123000


def test_malformed_drop_mode(spark):
    df = P.parse_logins(lines_df(spark, ["1,ip,fail,12x", "2,ip,fail", "3,ip,fail,100"]), on_error="drop")
    assert [r.user_id for r in df.collect()] == [3]


@pytest.mark.parametrize("bad", ["1,ip,fail,12x", "1,ip,fail"])
def test_malformed_fail_mode(spark, bad):
    with pytest.raises(PySparkException):
        P.parse_logins(lines_df(spark, [bad])).collect()


def test_text_source_roundtrip(spark, tmp_path):
    from eventlens.sources.text import read_lines
    p = tmp_path / "orders.csv"
    p.write_text("1,create,,100\n1,pay,tx1,200\n")
    df = P.parse_orders(read_lines(spark, str(p)))
    assert [r.event_type for r in df.orderBy("seq").collect()] == ["create", "pay"]
