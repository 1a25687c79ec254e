from __future__ import annotations

from datetime import datetime

from viewrank.sources.requests import check_requests, count_rejects, parse_requests

T = '"timestamp":"2024-06-01T14:32:00"'


def checked(spark, *bodies):
    df = check_requests(spark.createDataFrame([(b,) for b in bodies], "body STRING"))
    return {row.body: row for row in df.collect()}


def test_good_request_is_stripped_and_parsed(spark):
    body = '{"videoId":"  abc 123\\u00a0\\n","timestamp":"2024-06-01T23:30:00-07:00","extra":[1]}'
    row = checked(spark, body)[body]
    assert (row.video_id, row.ts, row.reason) == ("abc 123", datetime(2024, 6, 1, 23, 30), None)


def test_reasons(spark):
    expected = {
        f'{{"videoId":" \\t\\u3000",{T}}}': "empty_video_id",
        '{"videoId":"","timestamp":"yesterday"}': "empty_video_id",
        '{"videoId":"a","timestamp":"yesterday"}': "bad_timestamp",
        '{"videoId":"a","timestamp":"2024-02-30"}': "bad_timestamp",
        '{"videoId":"a"}': "malformed_body",
        f"{{{T}}}": "malformed_body",
        f'{{"videoId":5,{T}}}': "malformed_body",
        f'{{"videoId":-0.5e3,{T}}}': "malformed_body",
        f'{{"videoId":true,{T}}}': "malformed_body",
        f'{{"videoId":false,{T}}}': "malformed_body",
        f'{{"videoId":NaN,{T}}}': "malformed_body",
        f'{{"videoId":-Infinity,{T}}}': "malformed_body",
        f'{{"videoId":{{"a":1}},{T}}}': "malformed_body",
        f'{{"videoId":{{}},{T}}}': "malformed_body",
        f'{{"videoId":[],{T}}}': "malformed_body",
        '{"videoId":"a","timestamp":true}': "malformed_body",
        '{"videoId":"a","timestamp":{"t":1}}': "malformed_body",
        '{"videoId":"a","timestamp":null}': "malformed_body",
        '{"videoId":5,"timestamp":"yesterday"}': "malformed_body",
        '{"videoId":"5","timestamp":"1717252320"}': "bad_timestamp",
        '{"videoId":"a","timestamp":""}': "bad_timestamp",
        f'{{"videoId":null,{T}}}': "malformed_body",
        f'{{"videoId":["a"],{T}}}': "malformed_body",
        f'{{"VIDEOID":"a",{T}}}': "malformed_body",
        '{"videoId":"a","timestamp":1717252320}': "malformed_body",
        f'[{{"videoId":"a",{T}}}]': "malformed_body",
        "{'videoId':'a','timestamp':'2024-06-01'}": "malformed_body",
        f'{{"videoId":"a",{T}}} and more': "malformed_body",
        f'{{"videoId":"a",{T}}} {{"videoId":"b",{T}}}': "malformed_body",
        f'{{"videoId":"a",{T}}},{{"videoId":"b",{T}}}': "malformed_body",
        f'{{"videoId":"a",{T}}}]': "malformed_body",
        f'{{"videoId":"a",{T}}}] and more': "malformed_body",
        f'{{"videoId":"a",{T}': "malformed_body",
        "null": "malformed_body",
        "nonsense": "malformed_body",
        "": "malformed_body",
        None: "malformed_body",
    }
    got = checked(spark, *expected)
    assert {body: row.reason for body, row in got.items()} == expected


def test_unusual_but_good_bodies(spark):
    bodies = {
        f' \n{{"videoId":"a",{T}}}\r\n\t ': "a",
        f'{{"videoId":"a","videoId":"b",{T}}}': "b",
        f'{{"videoId":"\\ud83d\\ude00",{T},"x":{{"videoId":1}}}}': "😀",
        f'{{"videoId":"]","z":"}}]",{T}}}': "]",
        f'{{"videoId":"5",{T}}}': "5",
        f'{{"videoId":"true",{T}}}': "true",
        f'{{"videoId":"[1]",{T}}}': "[1]",
        f'{{"videoId":"-Infinity",{T}}}': "-Infinity",
        f'{{"videoId":" {{}} ",{T}}}': "{}",
    }
    got = checked(spark, *bodies)
    assert {body: (row.video_id, row.reason) for body, row in got.items()} == {
        body: (video, None) for body, video in bodies.items()
    }


def test_every_body_is_either_valid_or_rejected(spark):
    bodies = [f'{{"videoId":"a",{T}}}', '{"videoId":"a"}', "x", f'{{"videoId":" ",{T}}}']
    requests = spark.createDataFrame([(b,) for b in bodies], "body STRING")
    valid, refused = parse_requests(requests)
    assert valid.columns == ["video_id", "ts"]
    assert valid.count() == 1 and refused.count() == 3
    counts = dict(count_rejects(check_requests(requests)).collect())
    assert counts == {"malformed_body": 2, "empty_video_id": 1}
