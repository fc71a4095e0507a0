"""The rule table: one small payload of each site, read by the one job."""

import json

import pytest

from corvane.rules.cells import page_rows
from corvane.rules.job import site_versions, unread_payloads
from corvane.rules.sites import SITES, site_rules

ON, ENDED = "판매중", "판매중지"
KIND = "ingest_seq long, company string, context map<string,string>, body string"


def table(*rows, head=()):
    heads = "".join(f"<th>{h}</th>" for h in head)
    return f"<table><caption>상품</caption><tr>{heads}</tr>" + "".join(f"<tr>{''.join(r)}</tr>" for r in rows) + "</table>"


def td(text="", more=""):
    return f"<td{more}>{text}</td>"


def a(href, label="PDF", **more):
    return f"<a href=\"{href}\"{''.join(f' {k}={chr(34)}{v}{chr(34)}' for k, v in more.items())}>{label}</a>"


def under(path, rows):
    out = rows
    for name in reversed(path.split(".")):
        out = {name: out}
    return json.dumps(out, ensure_ascii=False)


#: company, context, body, then for each version: name, category, id, state, start, end, [(kind, address or locator, file name)].
CASES = [
    ("DB", {}, under("result", [{"PDC_NM": "가 ", "ARC_KND_LGCG_NM": "장기", "SQNO": 12, "ARC_PDC_SL_YN": "1", "SALE_BEGIN_DAY": "20260701", "INPL_FINM": "약 관+1.pdf", "PDC_EXPP_FINM": "x.pdf"}, {"PDC_NM": "나", "SALE_BEGIN_DAY": "bad"}]),
     [("가", "장기", "12", ON, "2026-07-01", None, [("POLICY", "https://www.idbins.com/cYakgwanDown.do?FilePath=InsProduct/%EC%95%BD%20%EA%B4%80%2B1.pdf", "약 관+1.pdf")]), ("나", "", "", ENDED, None, None, [])]),
    ("LOTTE", {"tab": ON}, table([td("구분"), td("상품"), td("2026.01.02 ~ 2026.03.04"), td(a("/d/a.pdf", '<img alt="보험약관PDF보기">')), td(a("javascript:stop()", "요약서")), td(a("https://o/b.pdf", "x", title="새창열림_사업방법서"))], [td("짧은 행")]),
     [("상품", "구분", "a.pdf", ON, "2026-01-02", "2026-03-04", [("POLICY", "https://www.lotteins.co.kr/d/a.pdf", "a.pdf"), ("METHOD", "https://o/b.pdf", "b.pdf")])]),
    ("MERITZ", {"tab": ENDED, "category": "운전자"}, under("list", [{"ttlNm": "다", "ntbdDtlSeq": 5, "bgnDt": "20260105", "putupEdDdTm": "20260205", "putupStDdTm": "20260106", "file1": "/s/t.pdf", "file1#[E]": "tok", "file2": "/no/token.pdf"}]),
     [("다", "운전자", "5", ENDED, "2026-01-05", "2026-02-05", [("POLICY", "https://www.meritzfire.com/hp/fileDownload.do?serverPath=/s/t.pdf", "t.pdf"), ("METHOD", "https://www.meritzfire.com/hp/fileDownload.do?serverPath=/no/token.pdf", "token.pdf")])]),
    ("KB", {"product_name": "라", "category": "암", "bojong_no": "1", "gubun": "", "bojong_seq": "3"}, table([td("20260101"), td("20260301"), td(a("/f?fileNm=q.pdf&x", "약관PDF 보기")), td(), td()], [td("LA0123"), td("현재"), td()]),
     [("라", "암", "1||3", ENDED, "2026-01-01", "2026-03-01", [("POLICY", "https://www.kbinsure.co.kr/f?fileNm=q.pdf&x", "q.pdf")]), ("라", "암", "1||3", ON, None, None, [])]),
    ("SAMSUNG", {}, under("responseMessage.body.data.list", [{"prdName": "마", "prdGun": "g", "prdGb": "b", "prdCode": "C", "jongGb": "", "displayGb": "0", "saleStDt": "20260101", "saleEnDt": "99991231"}, {"prdName": "바", "prdCode": "C", "jongGb": "J", "displayGb": "0", "saleEnDt": "20260505"}]),
     [("마", "g / b", "C", ON, "2026-01-01", None, []), ("바", "", "C_J", ENDED, None, "2026-05-05", [])]),
    ("KYOBO_LIFE", {"dgtPdtAtrNm": "사", "dgtPdtAtrMclCd": "M", "saleYn": "Y", "dgtPdtPdSeqtId": "9"}, json.dumps({"body": {"list": [{"saleStDt": "2026-07-01 00:00:00", "saleEdDt": ""}, {"saleStDt": "2026-01-01 00:00:00", "saleEdDt": "2026-06-30 00:00:00"}], "list2": [{"temp02": "7_약관.pdf"}]}}),
     [("사", "M", "9", ON, "2026-07-01", None, [("POLICY", "https://www.kyobo.com/file/ajax/download?fName=/dtc/pdf/mm/7_%EC%95%BD%EA%B4%80.pdf", "약관.pdf")]), ("사", "M", "9", ENDED, "2026-01-01", "2026-06-30", [])]),
    ("MIRAE_LIFE", {"tab": ENDED, "variant": "판매중지상품"}, under("list", [{"seq": 3, "jsonData": json.dumps({"cell0": "종신", "cell1": "아", "cell2": "20250101", "cell3": "20260101", "cell5": "a.pdf\nb.pdf", "cell8": "/dir"})}, {"seq": 4, "jsonData": json.dumps({"cell1": ""})}]),
     [("아", "종신", "3", ENDED, "2025-01-01", "2026-01-01", [("SUMMARY", "POST|filePath=/uploadwas/life/dir|fileName=a.pdf", "a.pdf"), ("SUMMARY", "POST|filePath=/uploadwas/life/dir|fileName=b.pdf", "b.pdf")])]),
    ("DB_LIFE", {"tab": ON, "channel": "대면"}, table(["<th>보장</th><th>종신</th><th>자</th>", td("2026.01.01 ~ 현재"), td(a("/notice/file/77/1")), td(a("file/77/2"))]),
     [("자", "대면 / 보장 / 종신", "77", ON, "2026-01-01", None, [("METHOD", "https://www.idblife.com/notice/file/77/1", ""), ("SUMMARY", "https://www.idblife.com/file/77/2", "")])]),
    ("DB_LIFE", {"variant": "sold_out", "channel": "TM"}, '<?xml version="1.0"?><r xmlns:n="u"><n:popList publish_no="5"><n:product_name>차 &amp; 타</n:product_name><SALE_START_DATE>20200101</SALE_START_DATE><FILE1_NAME><![CDATA[f.pdf]]></FILE1_NAME></n:popList><popList><PRODUCT_NAME>x</PRODUCT_NAME></popList></r>',
     [("차 & 타", "TM", "5", ENDED, "2020-01-01", None, [("METHOD", "https://www.idblife.com/notice/product/file/5/1", "f.pdf")])]),
    ("IBK_LIFE", {"tab": ON, "group": "연금"}, table([td("은행"), td("카"), td("2026.01.01 ~ 2026.02.01"), td(a("#", "받기", onclick="onDownload('/p', '12', '34')"))], [td("2026.03.01 ~"), td()], head=("판매채널", "상품명", "판매기간", "보험약관")),
     [("카", "연금 / 은행", "12", ENDED, "2026-01-01", "2026-02-01", [("POLICY", "POST|pFilePath=/p|pFidwSeq=1234", "")]), ("카", "연금 / 은행", "", ON, "2026-03-01", None, [])]),
    ("IM_LIFE", {"tab": ON, "channel": "개인"}, table(["<th>보장</th>", td("파", " rowspan=2"), td("20260101"), td(""), td(a("javascript:fileDownload('/x/요약서.pdf')")), td(), td()], [td("20250101"), td("20251231"), td(), td(), td()], [td("없음"), td(), td(), td(), td()]),
     [("파", "개인 / 보장", "", ON, "2026-01-01", None, [("SUMMARY", "POST|fileName=/x/요약서.pdf", "요약서.pdf")]), ("파", "개인 / 보장", "", ENDED, "2025-01-01", "2025-12-31", [])]),
    ("KB_LIFE", {"tab": ON}, under("list", [{"NAME": "하", "TYPE": "저축", "P_CODE": "", "SEQNO": 8, "SALE_DATE": "2026.01.01 ~", "PROD_SALE_END_DATE": "20260901", "UPFILE3": "/u/v.pdf", "UPFILE5": "/x.pdf"}]),
     [("하", "저축", "8", ENDED, "2026-01-01", "2026-09-01", [("POLICY", "https://www.kblife.co.kr/api/archive/archives/download/product-terms/8/8", "v.pdf")])]),
    ("METLIFE", {}, table(["<th class='bgW'>변액</th>", td("거"), td("<button>펼치기</button>")], [td("2026-01-01 ~ 현재"), td(a("/d?insProdSeq=4&seq=1", "방법서.pdf")), td(), td()], [td("-"), td(), td(), td()]),
     [("거", "변액", "4", ON, "2026-01-01", None, [("METHOD", "https://brand.metlife.co.kr/d?insProdSeq=4&seq=1", "방법서.pdf")])]),
    ("HANA_LIFE", {"tab": ON}, table([td("개인"), td("연금"), td("너"), td("2026.01.01 ~ 2026.01.31"), td(a("/d.do?code=Q1&downFileName=%EC%9A%94%EC%95%BD.pdf")), td(), td()]),
     [("너", "개인 / 연금", "Q1", ENDED, "2026-01-01", "2026-01-31", [("SUMMARY", "https://www.hanalife.co.kr/d.do?code=Q1&downFileName=%EC%9A%94%EC%95%BD.pdf", "요약.pdf")])]),
    ("HANA_NON_LIFE", {"tab": ON, "sPrdNm": "더", "sInsTypeName": "장기", "sPrdKeyID": "K"}, under("body", {"sSaleStrDt": "20260101", "sSaleEndDt": "", "sBizFileID": "B9"}), [("더", "장기", "K", ON, "2026-01-01", None, [("METHOD", "https://m.hanainsure.co.kr/download/B9", "")])]),
    ("HYUNDAI_MARINE", {"tab": ON, "category": "장기보험"}, under("data.hhca0051VOList", [{"prodNm": "러", "insCd": None, "seqno": 7, "slStDt": " 20260101 ", "slEdDt": "99991231", "clauApnflId": "ap1", "prodNoteApnflId": "n"}]), [("러", "장기보험", "7", ON, "2026-01-01", None, [("POLICY", "POST|apnflId=ap1", "")])]),
    ("HEUNGKUK_FIRE", {"tab": ON, "category": "장기"}, table(*[[td("건강"), td("2026"), td("머"), td("2026.05.01"), td(a("#", "약관", onclick="fn_filedownX('/p','r.pdf','s.pdf')") + a("#", "사업방법서", onclick="fn_filedownX('/p','t.pdf','u.pdf')"))]] * 2),
     [("머", "장기 / 건강", "", ON, "2026-05-01", None, [("POLICY", "POST|filePath=/p|fileSaveName=s.pdf|fileRealName=r.pdf", "r.pdf"), ("METHOD", "POST|filePath=/p|fileSaveName=u.pdf|fileRealName=t.pdf", "t.pdf")])]),
    ("HEUNGKUK_LIFE", {"tab": ON, "name": "버", "category": "종신"}, "a%||%b%||%2026-01-01%,%2026-02-02%,%보장%,%ID%,%tk%,%f.pdf%|%짧음%,%x", [("버", "종신", "ID", ENDED, "2026-01-01", "2026-02-02", [("POLICY", "encValue=tk|POST|fileName=f.pdf", "f.pdf")])]),
    ("ABL_LIFE", {"tab": ENDED, "name": "서", "category": "변액", "url": "https://abllife.co.kr/x?page=whl/7"}, table([td("2020.01.01 ~ 2021.01.01"), td(a("/f/방법서.pdf")), td(), td()]), [("서", "변액", "whl/7", ENDED, "2020-01-01", "2021-01-01", [("METHOD", "https://abllife.co.kr/f/방법서.pdf", "방법서.pdf")])]),
    ("KDB_LIFE", {"tab": ON, "group": "다이렉트"}, under("resultList", [{"GP": "A", "PRODUCT_NAME": "어", "CATEGORY_DEPTH": "정기"}, {"GP": "B", "PRODUCT_NAME": "", "PRODUCT_IDX": 1, "SALE_START_DATE": "20260101", "AGREEMENT": "/a/b.pdf^1^2^3", "PRODUCT_GUIDE": "/pop.html"}, {"GP": "B", "PRODUCT_NAME": "저", "SALE_START_DATE": "20260101"}, {"GP": "B", "PRODUCT_NAME": "", "SALE_START_DATE": "20260101"}]),
     [("어", "다이렉트 / 정기", "1", ON, "2026-01-01", None, [("POLICY", "https://www.kdblife.com/a/b.pdf", "b.pdf")]), ("저", "다이렉트 / 정기", "", ON, "2026-01-01", None, [])]),
    ("NH_LIFE", {"tab": ON, "name": "처", "kind": "연금"}, table([td("2026.01.01 ~"), td(a("javascript:popupPdfViewer('F1', '0')")), td(), td("파일 없음")]), [("처", "연금", "F1", ON, "2026-01-01", None, [("SUMMARY", "https://www.nhlife.co.kr/pdfViewer.nhl?apdFlid=F1&fileSeqn=0", "")])]),
    ("TONGYANG_LIFE", {"tab": ON}, table([td("1"), td("FC"), td("종신"), td("커"), td("20260101"), td("20260201"), td(a("javascript:MasFiledownload('a', 'G7')", '<img alt="약관">'))]), [("커", "FC / 종신", "", ENDED, "2026-01-01", "2026-02-01", [("POLICY", "POST|fileGrpId=G7", "")])]),
    ("LINA_LIFE", {"tab": ON, "kind": "보장"}, under("listDisclosure", [{"insNm": "터", "inscd": "I1", "kliaProdClcd": "02", "sellOpnDt": "20260101", "sellEndDt": "99991231", "productMethod": "-"}, {"insNm": "again", "inscd": "I1"}]), [("터", "보장 / 02", "I1", ON, "2026-01-01", None, [])]),
    ("LINA_NON_LIFE", {"tab": ON, "category": "여행"}, table([td("퍼", " rowspan=2"), td("2026.01.01 ~"), td(), td(a("p.pdf")), td()], [td("2025.01.01 ~ 2025.12.31"), td(), td(), td()], head=("상품명", "기간", "a", "b", "c")),
     [("퍼", "여행", "", ON, "2026-01-01", None, [("POLICY", "https://ec.aceinsurance.co.kr/p.pdf", "")]), ("퍼", "여행", "", ENDED, "2025-01-01", "2025-12-31", [])]),
    ("SAMSUNG_LIFE", {}, under("list", [{"goodsName": "허", "goodsCode": "G", "lCode": "", "gubun": "건강", "fromdate": "20260101", "filename1": "1767225600000", "filename2": "x1"}, {"goodsName": "no code"}]),
     [("허", "건강", "G", ON, "2026-01-01", None, [("SUMMARY", "https://pcms.samsunglife.com/uploadDir/doc/2026/0101/G/201/1767225600000.pdf", "1767225600000.pdf")])]),
    ("SHINHAN_LIFE", {"tab": ON}, under("elData.nodeInfoVoList", [{"meta05": "고", "meta03": "변액", "meta02": "TM", "ndId": "N", "meta07": "2026010112", "meta08": "20261231235959", "meta11": "/r/p.pdf"}]), [("고", "변액 / TM", "N", ENDED, "2026-01-01", "2026-12-31", [("POLICY", "repoPath=/r/p.pdf", "p.pdf")])]),
    ("HANWHA_LIFE", {"tab": ON, "goods_name": "노", "category": "건강", "idx": "31"}, under("list3", [{"GOODS_NAME": "", "SELL_START_DT": "20260101", "FILE_NAME2": "m.pdf", "FILE_NAME3": "t.pdf", "FILE_NAME12": "t2.pdf", "FILE_NAME3_x": "no"}]),
     [("노", "건강", "31", ON, "2026-01-01", None, [("METHOD", "POST|fileName=m.pdf", "m.pdf"), ("POLICY", "POST|fileName=t2.pdf", "t2.pdf"), ("POLICY", "POST|fileName=t.pdf", "t.pdf")])]),
    ("NH_FIRE", {"tab": ON, "group": "장기", "kind": "암", "code": "7", "product_name": "도"}, "<r><pdtSelStDt>20260101</pdtSelStDt><pdtSelStDt>20250101</pdtSelStDt><pdtSelEdDt/><pdtSelEdDt>20251231</pdtSelEdDt><pdtNm> 로 </pdtNm><fileId>F</fileId><bzMtdAfileNm>b.pdf</bzMtdAfileNm><bzMtdAfileSeqn>2</bzMtdAfileSeqn><smmrAfileNm>s.pdf</smmrAfileNm></r>",
     [("로", "장기 / 암", "7", ON, "2026-01-01", None, [("METHOD", "https://www.nhfire.co.kr/imageView/downloadFile.ajax?fileId=F&afileSeqn=2", "b.pdf")]), ("도", "장기 / 암", "7", ENDED, "2025-01-01", "2025-12-31", [])]),
    ("AIG", {"tab": ON}, under("list", [{"pdnm": "모", "mclfNm": "여행", "pancId": 4, "stDt": "2026-01-01T00:00", "endt": None, "clauFileId": "C", "clauFileSeqn": 1, "bzMthdFileId": "B"}]),
     [("모", "여행", "4", ON, "2026-01-01", None, [("POLICY", "https://www.aig.co.kr/downLoadFiles.do?fileId=C&fileSeq=1&fileType=&fileGb=&viewType=", "")])]),
]


@pytest.fixture(scope="module")
def read(spark):
    """All sites' payloads through the job at once."""
    rows = site_versions(spark.createDataFrame([(i, c, ctx, body) for i, (c, ctx, body, _) in enumerate(CASES)], KIND)).collect()
    out = {}
    for r in sorted(rows, key=lambda r: (r.ingest_seq, r.row_no)):
        docs = [(d.document_type, d.document_url or d.source_locator, d.original_filename) for d in r.documents]
        out.setdefault(r.ingest_seq, []).append((r.product_name_raw, r.product_category, r.source_product_id, r.sale_status, r.sale_start_date and str(r.sale_start_date), r.sale_end_date and str(r.sale_end_date), docs))
    return out


@pytest.mark.parametrize("i", range(len(CASES)), ids=[f"{c[0]}-{i}" for i, c in enumerate(CASES)])
def test_site(read, i):
    assert read.get(i, []) == CASES[i][3]


def test_every_company_has_a_rule_and_a_case(spark):
    assert len({s.company for s in SITES}) == 28 and {s.company for s in SITES} == {c[0] for c in CASES}
    assert site_rules(spark).groupBy("company", "variant").count().where("count > 1").isEmpty()


def test_unread_payloads(spark):
    rows = [(1, "DB", None, "<html>"), (2, "DB", {}, '{"result":{"a":1}}'), (3, "DB", {}, '{"result":[1]}'), (4, "DB", {}, '{"result":[]}'), (5, "NONE", None, "x"), (6, "DB_LIFE", {"variant": "sold_out"}, "<html><body/></html>"), (7, "DB", {}, None), (8, "MIRAE_LIFE", {}, "{}"), (9, "KB", {}, "")]
    df = spark.createDataFrame(rows, KIND)
    got = sorted((r.ingest_seq, r.reason) for r in unread_payloads(df).collect())
    assert got == [(1, "UNREADABLE"), (3, "UNREADABLE"), (5, "NO_RULE"), (6, "UNREADABLE"), (7, "UNREADABLE"), (8, "NO_RULE")]
    assert [r.ingest_seq for r in site_versions(df).collect()] == []


def test_a_new_site_is_a_new_rule(spark):
    from corvane.rules.sites import Doc, Site

    own = Site("NEW", "json", "a.b", "https://new", "/p", ("t",), (), ("first", "k"), ("tab",), (Doc("약관", "f", ("^",)),), ("s",))
    df = spark.createDataFrame([(1, "NEW", {"tab": ON}, '{"a":{"b":[{"t":"x","k":1,"s":"20260102","f":"/q.pdf"}]}}')], KIND)
    r = site_versions(df, site_rules(spark, (own,))).first()
    assert (r.product_name_raw, r.version_key, r.documents[0].document_url) == ("x", "20260102_판매개시", "https://new/q.pdf")


def test_rows_of_pages():
    assert page_rows("<table><tr><td>a<table><tr><td>b</td></tr></table></td></tr>", None)[-1]["td0"] == "b"
    assert page_rows(None, None) == [] and page_rows("<table><tr><td", None) == []
