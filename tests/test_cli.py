"""The command line runs a batch over CSV feeds and compacts a table."""

import json

from quayside.__main__ import main
from quayside.sinks.lake_table import read_lake

EVENTS = """event_id,event_type,session_id,user_id,event_ts,page,partner_id,device,country,channel,price_usd,metadata_json,is_bot_flag,ingest_date
e-1,page_view,s1,,2025-03-30 10:00:00,/,PRT0001,Mobile, br,direct,,"{""ab_test"":""A""}",False,2025-03-30
e-1,PAGE_VIEW,s1,,2025-03-30 10:00:00,/x,PRT0001,Mobile,br,direct,12.5,,False,2025-03-31
e-2,search,s2,u2,2025-03-31 11:00:00,,,DESKTOP,,,,,True,2025-03-31
"""
TXNS = """transaction_id,booking_ref,partner_id,user_id,created_at,ingest_ts,amount,currency,status,payment_method,gateway,retry_count,error_code,notes,processing_ms
t-1,b1,PRT0001,,2025-03-20 10:00:00,2025-03-30 10:00:00,100.00,brl,CONFIRMED,pix,stripe,0,,ok,320
t-2,b2,PRT0001,u2,2025-03-31 10:00:00,2025-03-31 10:05:00,-5.00,BRL,failed,,,,E001,,
"""
PARTNERS = """partner_id,schema_version,name,country_code,status,tier,commission_rate,created_at,updated_at,sla_hours,avg_rating,api_endpoint,webhook_enabled
PRT0001,v1,P1,br,ACTIVE,gold,0.15,2024-01-01 00:00:00,,,,,
PRT0001,V2,P1,br,Active,,0.15,2024-01-01 00:00:00,2025-01-01 00:00:00,24,4.5,,
"""
PAYMENTS = """event_id,event_type,transaction_id,user_id,partner_id,amount,currency,status,gateway,event_ts,kafka_offset,kafka_partition,processing_lag_ms,is_spike
p-1,payment_approved,t-1,,PRT0001,100.00,BRL,APPROVED,,2025-03-30 10:00:00,0,0,120,False
p-1,payment_approved,t-1,,PRT0001,100.00,BRL,approved,,2025-03-30 10:00:00,1,0,,False
p-2,payment_refused,t-2,u2,PRT0001,5.00,BRL,refused,adyen,2025-03-31 10:00:00,0,1,5800,True
"""


def test_cli_run_and_compact(spark, tmp_path, scratch, capsys):
    raw = tmp_path / "raw"
    raw.mkdir()
    for name, text in [("raw_events", EVENTS), ("raw_transactions", TXNS),
                       ("raw_partner_catalog", PARTNERS), ("raw_payment_stream", PAYMENTS)]:
        (raw / f"{name}.csv").write_text(text, encoding="utf-8")
    lake = scratch("cli-lake")
    main(["run", "--input", str(raw), "--output", lake])
    first = json.loads(capsys.readouterr().out)
    assert (first["events"], first["bots"], first["transactions"], first["rejected_transactions"],
            first["partners"], first["payments"], first["mode"]) == (1, 1, 1, 1, 2, 2, "full")
    ev = read_lake(spark, f"{lake}/events", "events").collect()[0]
    assert (ev["event_type"], ev["page"], ev["country"], ev["price_usd"]) == ("page_view", "/x", "BR", 12.5)
    pay = {r["event_id"]: r["kafka_offset"] for r in read_lake(spark, f"{lake}/payments", "payments").collect()}
    assert pay == {"p-1": 1, "p-2": 0}
    main(["run", "--input", str(raw), "--output", lake])
    second = json.loads(capsys.readouterr().out)
    assert second["mode"] == "incremental" and second["payments"] == 0
    main(["compact", f"{lake}/events"])
    listed = [json.loads(line) for line in capsys.readouterr().out.splitlines()]
    assert listed and all(not r["compacted"] for r in listed)
