"""What each site's list payloads say where: one rule for each company and form of payload. Rules are data; ``job`` applies them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Doc:
    """One document, or several, of a row.

    ``cell`` names the cell that tells of it ("~..." is a pattern: all cells that match, by name), ``of`` what of that cell is its value: "" the text, "href" the address
    of a link in it, "arg0" the first argument of a call in it, and so on. ``label`` is the document's label, "=" the link's own. ``url`` and ``hint`` are joined from pieces:
    "$x" is cell x, "%x" the same percent-encoded, "&x" what x says of the document's own cell, "$" or "%" alone the value, "+" the site's base ahead of a value
    that isn't a whole address, "^" the value resolved against the base, "@stamp" the day of a value in milliseconds; others stand for themselves. A piece that is blank
    makes url or hint empty; a document without either goes. ``file``: how its file name comes from the value.
    """

    label: str
    cell: str
    url: tuple[str, ...] = ()
    hint: tuple[str, ...] = ()
    file: str = "base"
    of: str = ""
    lines: bool = False


@dataclass(frozen=True)
class Site:
    """How the rows of one company's payloads become product versions; cells may be those of the row or of the payload's context.

    ``form``: json, html, xml, columns (parallel lists of XML), marks (rows of marked texts); ``rows``: the path, tag or marks of its rows. ``zipped``: a second
    list whose rows go with the first's by place. ``inner``: a cell that holds more cells as JSON. ``head``: a row of so many cells begins with one that spans the rows below, named "head". ``carried``: cells that
    keep their last value down the rows, with ``title`` only from rows in which that cell has that value, which are no versions themselves.
    ``product_id``: how, then cells. ``state``: which rule, then its cell. ``period``, ``start``, ``end``: the first filled cell counts. ``identity``: of rows that agree in these the
    first counts. ``required``: rows that lack one of these go.
    """

    company: str
    form: str
    rows: str
    base: str
    page: str
    name: tuple[str, ...]
    category: tuple[str, ...]
    product_id: tuple[str, ...]
    state: tuple[str, ...]
    docs: tuple[Doc, ...]
    start: tuple[str, ...] = ()
    end: tuple[str, ...] = ()
    period: tuple[str, ...] = ()
    disclosed: tuple[str, ...] = ()
    variant: str = ""
    cut: int = 0
    zipped: str = ""
    inner: str = ""
    least_cells: int = 0
    head: int = 0
    carried: tuple[str, ...] = ()
    title: tuple[str, ...] = ()
    identity: tuple[str, ...] = ()
    required: tuple[str, ...] = ("product_name_raw",)
    undated: str = ""


_TERMS, _METHOD, _SUMMARY, _OTHER = "약관", "사업방법서", "상품요약서", "상품설명서"
_INSURANCE_TERMS = "보험약관"
_CODED = ("product_name_raw", "sale_start_date", "sale_end_date", "source_product_id")


def _by_place(labels: tuple[str, ...], first: int, **how) -> tuple[Doc, ...]:
    return tuple(Doc(label, f"td{first + i}", **how) for i, label in enumerate(labels))


def _posted(cell: str, label: str, key: str, **how) -> Doc:
    return Doc(label, cell, hint=("POST|", f"{key}=", "$"), **how)


def _mirae(variant: str, first: int) -> Site:
    docs = tuple(
        Doc(label, f"cell{first + i}", hint=("POST|filePath=/uploadwas/life", f"$cell{first + 3}", "|fileName=", "$"), file="whole", lines=True) for i, label in enumerate((_SUMMARY, _TERMS, _METHOD))
    )
    return Site("MIRAE_LIFE", "json", "list", "https://life.miraeasset.com", "/micro/disclosure/product/PC-HO-080301-000000.do", ("cell1",), ("cell0",), ("first", "seq"), ("tab",), docs, ("cell2",), ("cell3",), variant=variant, inner="jsonData", identity=("seq",))


#: Names of cells, labels, addresses and marks are those of the sites.
SITES = (
    Site("DB", "json", "result", "https://www.idbins.com", "", ("PDC_NM",), ("ARC_KND_LGCG_NM",), ("first", "SQNO"), ("flag", "ARC_PDC_SL_YN"),
         tuple(Doc(label, cell, ("https://www.idbins.com/cYakgwanDown.do?FilePath=InsProduct/", "%"), file="whole") for cell, label in (("INPL_FINM", _INSURANCE_TERMS), ("BIZ_MDDC_FINM", _METHOD), ("CNSL_SMAR_FINM", _SUMMARY), ("PDC_EXPP_FINM", _OTHER))),
         ("SALE_BEGIN_DAY",)),
    Site("LOTTE", "html", "", "https://www.lotteins.co.kr", "", ("td1",), ("td0",), ("file",), ("tab",), (Doc("=", r"~^td([3-9]|\d\d)$", ("+",), of="href"),), period=("td2",), least_cells=3),
    Site("MERITZ", "json", "list", "https://www.meritzfire.com", "/disclosure/product-announcement/product-list.do?vMode=PC", ("ttlNm",), ("category",), ("first", "ntbdDtlSeq"), ("tab",),
         tuple(Doc(label, f"file{i}", ("https://www.meritzfire.com/hp/fileDownload.do?serverPath=", "$"), ("token=", f"$file{i}#[E]")) for i, label in enumerate((_TERMS, _METHOD, _SUMMARY, _OTHER), 1)),
         ("bgnDt",), ("putupEdDdTm",), disclosed=("putupStDdTm",)),
    Site("KB", "html", "", "https://www.kbinsure.co.kr", "/CG802030001.ec", ("product_name",), ("category",), ("all", "bojong_no", "gubun", "bojong_seq"), ("open",), (Doc("=", "~^td[2-4]$", ("+",), of="href", file="?fileNm"),),
         ("td0",), ("td1",), least_cells=3, undated="날짜미상_"),
    Site("SAMSUNG", "json", "responseMessage.body.data.list", "https://www.samsungfire.com", "", ("prdName",), ("prdGun", "prdGb"), ("joined", "prdCode", "jongGb"), ("flag_end", "displayGb"),
         tuple(Doc(label, f"prdfilename{i}", ("+",)) for i, label in enumerate((_INSURANCE_TERMS, _METHOD, _SUMMARY, _OTHER), 1)), ("saleStDt",), ("saleEnDt",)),
    Site("KYOBO_LIFE", "json", "body.list", "https://www.kyobo.com", "/dgt/web/product-official/all-product/search", ("dgtPdtAtrNm",), ("dgtPdtAtrMclCd", "dgtPdtAtrSmclCd"), ("first", "dgtPdtCd", "dgtPdtPdSeqtId"), ("yes_open", "saleYn"),
         tuple(Doc(label, f"temp0{i}", ("https://www.kyobo.com/file/ajax/download?fName=/dtc/pdf/mm/", "%"), file="after") for i, label in enumerate((_SUMMARY, _TERMS, _METHOD), 1)),
         ("saleStDt",), ("saleEdDt",), cut=10, zipped="body.list2"),
    _mirae("판매중인상품", 4),
    _mirae("판매중지상품", 5),
    Site("DB_LIFE", "html", "", "https://www.idblife.com", "/notice/product/sale", ("th2",), ("channel", "th0", "th1"), ("link", r"/file/(\d+)/"), ("ended",), tuple(Doc(label, f"td{i}", ("^",), of="href", file="none") for i, label in ((1, _METHOD), (2, _SUMMARY))), period=("td0",), least_cells=3),
    Site("DB_LIFE", "xml", "poplist", "https://www.idblife.com", "/notice/product/sold_out", ("PRODUCT_NAME",), ("channel", "MAIN_CTG"), ("first", "PUBLISH_NO"), ("fixed", "판매중지"),
         (Doc(_METHOD, "FILE1_NAME", ("https://www.idblife.com/notice/product/file/", "$PUBLISH_NO", "/1"), file="whole"),), ("SALE_START_DATE",), ("SALE_END_DATE",), variant="sold_out", required=("product_name_raw", "source_product_id"), undated="판매중지"),
    Site("IBK_LIFE", "html", "", "https://www.ibki.co.kr", "/process/", ("상품명",), ("group", "판매채널"), ("argument", "arg1"), ("ended",), (Doc("=head", "~^[^@]*(약관|방법서|요약서)[^@]*$", hint=("POST|pFilePath=", "&arg0", "|pFidwSeq=", "&arg1", "&arg2"), of="arg2", file="none"),),
         period=("판매기간",), carried=("판매채널", "상품명"), required=("product_name_raw", "period")),
    Site("IM_LIFE", "html", "", "https://www.imlifeins.co.kr", "/BA/BA_A020.do", ("head",), ("channel", "th0"), ("none",), ("ended",), tuple(_posted(f"td{i}", label, "fileName", of="arg0") for i, label in enumerate((_SUMMARY, _METHOD, _INSURANCE_TERMS), 2)),
         ("td0",), ("td1",), least_cells=5, head=6, carried=("head", "th0"), required=("product_name_raw", "sale_start_date")),
    Site("KB_LIFE", "json", "list", "https://www.kblife.co.kr", "/customer-common/productList.do", ("NAME",), ("TYPE",), ("joined", "P_CODE", "SEQNO"), ("ended",),
         tuple(Doc(label, cell, (f"https://www.kblife.co.kr/api/archive/archives/download/{kind}/", "$SEQNO", f"/{box}"))
               for cell, label, kind, box in (("UPFILE", _SUMMARY, "product-explain", 0), ("UPFILE1", _METHOD, "product-explain", 1), ("UPFILE2", _TERMS, "product-terms", 2), ("UPFILE3", _TERMS, "product-terms", 8), ("UPFILE4", _TERMS, "product-terms", 9), ("UPFILE5", _OTHER, "product-explain", 100))),
         end=("PROD_SALE_END_DATE",), period=("SALE_DATE",)),
    Site("METLIFE", "html", "", "https://brand.metlife.co.kr", "/pn/mcvrgProd/retrieveMcvrgProdMain.do", ("head",), ("th0",), ("last_link", r"[?&]insProdSeq=([^&]+)"), ("open",), _by_place((_METHOD, _SUMMARY, _TERMS), 1, url=("^",), of="href", file="text"),
         period=("td0",), least_cells=1, head=8, carried=("head", "th0"), required=("product_name_raw", "sale_start_date")),
    Site("HANA_LIFE", "html", "", "https://www.hanalife.co.kr", "/anm/product/allProduct.do", ("td2",), ("td0", "td1"), ("link", r"code=([^&]*)"), ("ended",), _by_place((_SUMMARY, _METHOD, _INSURANCE_TERMS), 4, url=("^",), of="href", file="??downFileName"), period=("td3",), least_cells=7),
    Site("HANA_NON_LIFE", "json", "body", "https://m.hanainsure.co.kr", "", ("sPrdNm",), ("sInsTypeName", "sInsDtlTypeName"), ("first", "sPrdCd", "sPrdKeyID"), ("ended",),
         tuple(Doc(label, cell, ("https://m.hanainsure.co.kr/download/", "$"), file="none") for cell, label in (("sPolicyFileID", _TERMS), ("sBizFileID", _METHOD), ("sSummaryFileID", _SUMMARY))), ("sSaleStrDt",), ("sSaleEndDt",)),
    Site("HYUNDAI_MARINE", "json", "data.hhca0051VOList", "https://www.hi.co.kr", "/serviceAction.do?view=bin%2FPA%2F03%2FHHPA03020M", ("prodNm",), ("category",), ("first", "insCd", "seqno"), ("ended",),
         tuple(_posted(cell, label, "apnflId", file="none") for cell, label in (("clauApnflId", _TERMS), ("userMthdApnflId", _METHOD), ("prodSmryApnflId", _SUMMARY), ("prodNoteApnflId", _OTHER))), ("slStDt",), ("slEdDt",)),
    Site("HEUNGKUK_FIRE", "html", "", "https://www.heungkukfire.co.kr", "/FRW/announce/insGoodsGongsiSale.do", ("td2",), ("category", "td0"), ("none",), ("ended",),
         (Doc("=", r"~^td4(\+\d+)?$", hint=("POST|filePath=", "&arg0", "|fileSaveName=", "&arg2", "|fileRealName=", "&arg1"), of="arg1", file="whole"),), period=("td3",), least_cells=5, identity=("product_name_raw", "sale_start_date", "product_category")),
    Site("HEUNGKUK_LIFE", "marks", "%||% 3 %|% %,%", "https://www.heungkuklife.co.kr", "/front/public/saleProduct.do?searchFlgSale=Y", ("name",), ("category",), ("first", "3"), ("ended",),
         tuple(Doc(label, str(cell), hint=("encValue=", f"${token}", "|POST|fileName=", "$"), file="whole") for token, cell, label in ((4, 5, _TERMS), (6, 7, _METHOD), (8, 9, _SUMMARY))), ("0",), ("1",), least_cells=6),
    Site("ABL_LIFE", "html", "", "https://abllife.co.kr", "", ("name",), ("category",), ("context_link", "url", "page=(.*)$"), ("ended",), _by_place((_METHOD, _SUMMARY, _TERMS), 1, url=("^",), of="href"), period=("td0",), least_cells=4),
    Site("KDB_LIFE", "json", "resultList", "https://www.kdblife.com", "/ajax.do?pcmode=1", ("PRODUCT_NAME",), ("group", "CATEGORY_NAME|CATEGORY_DEPTH"), ("first", "PRODUCT_IDX"), ("ended",),
         tuple(Doc(label, cell, ("^",), of="marked") for cell, label in (("AGREEMENT", _TERMS), ("PRODUCT_SUMMARY", _METHOD), ("PRODUCT_GUIDE", _SUMMARY))), ("SALE_START_DATE",), ("SALE_END_DATE",),
         carried=("PRODUCT_NAME", "CATEGORY_DEPTH"), title=("GP", "A"), identity=("product_name_raw", "sale_start_date", "sale_end_date", "product_category")),
    Site("NH_LIFE", "html", "", "https://www.nhlife.co.kr", "/ho/on/HOON0004M00.nhl", ("name",), ("kind",), ("argument", "arg0"), ("ended",),
         _by_place((_SUMMARY, _METHOD, _INSURANCE_TERMS), 1, url=("https://www.nhlife.co.kr/pdfViewer.nhl?apdFlid=", "&arg0", "&fileSeqn=", "&arg1"), of="arg1", file="none"), period=("td0",), least_cells=4),
    Site("TONGYANG_LIFE", "html", "", "https://pbano.myangel.co.kr", "", ("td3",), ("td1", "td2"), ("none",), ("ended",), (_posted(r"~^td([6-9]|\d\d)(\+\d+)?$", "=", "fileGrpId", of="arg1", file="none"),), ("td4",), ("td5",), least_cells=6,
         identity=("product_name_raw", "sale_start_date", "sale_end_date")),
    Site("LINA_LIFE", "json", "listDisclosure", "https://www.lina.co.kr", "/disclosure/product-public-announcement/product-on-sales", ("insNm",), ("kind", "kliaProdClcd"), ("first", "inscd"), ("ended",),
         tuple(Doc(label, cell, ("https://www.lina.co.kr/cms/upload/upload/docs/disclosure/", "$"), file="whole") for cell, label in (("productProvision", _TERMS), ("productMethod", _METHOD), ("productSumary", _SUMMARY))),
         ("sellOpnDt",), ("sellEndDt",), identity=("source_product_id",)),
    Site("LINA_NON_LIFE", "html", "", "https://ec.aceinsurance.co.kr", "/jsp/acelimited/notice/productNoticeV2.jsp", ("head",), ("category",), ("none",), ("ended",), _by_place((_METHOD, "상품약관", _SUMMARY), 1, url=("^",), of="href", file="none"),
         period=("td0",), least_cells=4, head=5, carried=("head",)),
    Site("SAMSUNG_LIFE", "json", "list", "https://www.samsunglife.com", "/individual/products/disclosure/sales/PDO-PRPRI010110M", ("goodsName",), ("gubun",), ("first", "goodsCode"), ("text", "lCode"),
         tuple(Doc(label, f"filename{i}", ("https://pcms.samsunglife.com/uploadDir/doc/", "@stamp", "/", "$goodsCode", f"/{kind}/", "$", ".pdf"), file="pdf") for i, label, kind in ((1, _SUMMARY, 201), (2, _METHOD, 401), (3, _INSURANCE_TERMS, 301))),
         ("fromdate",), ("todate",), identity=_CODED, required=("product_name_raw", "source_product_id")),
    Site("SHINHAN_LIFE", "json", "elData.nodeInfoVoList", "https://www.shinhanlife.co.kr", "/hp/", ("meta05",), ("meta03", "meta02"), ("first", "meta04", "ndId"), ("ended",),
         tuple(Doc(label, cell, hint=("repoPath=", "$")) for cell, label in (("meta11", _TERMS), ("meta10", _METHOD), ("meta09", _SUMMARY))), ("meta07",), ("meta08",), cut=8),
    Site("HANWHA_LIFE", "json", "list3", "https://www.hanwhalife.com", "/main/disclosure/goods/disclosurenotice/DF_GDDN000_P10000.do", ("GOODS_NAME", "goods_name"), ("category",), ("first", "idx"), ("ended",),
         (_posted("FILE_NAME1", _SUMMARY, "fileName", file="whole"), _posted("FILE_NAME2", _METHOD, "fileName", file="whole"), _posted(r"~^FILE_NAME([3-9]|\d{2,})$", _TERMS, "fileName", file="whole")), ("SELL_START_DT",), ("SELL_END_DT",)),
    Site("NH_FIRE", "columns", "pdtSelStDt", "https://www.nhfire.co.kr", "/announce/productAnnounce/retrieveInsuranceProductsAnnounce.nhfire", ("pdtNm", "product_name"), ("group", "kind"), ("first", "code"), ("ended",),
         tuple(Doc(label, f"{cell}AfileNm", ("https://www.nhfire.co.kr/imageView/downloadFile.ajax?fileId=", "$fileId", "&afileSeqn=", f"${cell}AfileSeqn"), file="whole") for cell, label in (("plcnd", _TERMS), ("smmr", _SUMMARY), ("bzMtd", _METHOD))),
         ("pdtSelStDt",), ("pdtSelEdDt",)),
    Site("AIG", "json", "list", "https://www.aig.co.kr", "", ("pdnm",), ("mclfNm",), ("first", "prodCd", "pancId"), ("ended",),
         tuple(Doc(label, f"{cell}FileId", ("https://www.aig.co.kr/downLoadFiles.do?fileId=", "$", "&fileSeq=", f"${cell}FileSeqn", "&fileType=&fileGb=&viewType="), file="none") for cell, label in (("clau", _TERMS), ("bzMthd", _METHOD), ("prodSmry", _SUMMARY))),
         ("stDt",), ("endt",), cut=10),
)

_LIST = "array<string>"
SCHEMA = (
    f"company string, form string, rows string, base string, page string, name {_LIST}, category {_LIST}, product_id {_LIST}, state {_LIST}, "
    f"docs array<struct<label:string,cell:string,url:{_LIST},hint:{_LIST},file:string,of:string,lines:boolean>>, start {_LIST}, end {_LIST}, period {_LIST}, disclosed {_LIST}, "
    f"variant string, cut int, zipped string, inner string, least_cells int, head int, carried {_LIST}, title {_LIST}, identity {_LIST}, required {_LIST}, undated string"
)


def site_rules(spark: SparkSession, sites: tuple[Site, ...] = SITES) -> DataFrame:
    """The rules as a table, a row for each company and variant."""
    fields = [part.split()[0] for part in SCHEMA.split(", ")]

    def plain(value):
        return [tuple(map(plain, vars(d).values())) if isinstance(d, Doc) else d for d in value] if isinstance(value, tuple) else value

    return spark.createDataFrame([tuple(plain(getattr(s, f)) for f in fields) for s in sites], SCHEMA)
