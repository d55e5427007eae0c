"""Words, labels, patterns and messages that results must agree with."""

MARKER = "NỘI DUNG VỤ ÁN"
THRESHOLD = 82.0
LOW_CONFIDENCE = 0.5
RULE_CONFIDENCE = 0.45

CASE_FIELDS = {
    "loai_an": "LOẠI ÁN",
    "so_thu_ly": "SỐ THỤ LÝ",
    "ngay_thu_ly": "NGÀY THỤ LÝ",
    "quan_he_phap_luat": "QUAN HỆ PHÁP LUẬT",
    "chu_toa": "HỌ TÊN CHỦ TỌA",
}
PARTY_FIELDS = {
    "tu_cach_to_tung": "TƯ CÁCH TỐ TỤNG",
    "ho_ten": "HỌ TÊN ĐƯƠNG SỰ",
    "nam_sinh": "NĂM SINH",
    "cccd": "CCCD",
    "dia_chi": "ĐỊA CHỈ",
}
PUBLIC_CASE_KEYS = {
    "case_type": "loai_an",
    "docket_number": "so_thu_ly",
    "docket_date": "ngay_thu_ly",
    "legal_relationship": "quan_he_phap_luat",
    "presiding_judge": "chu_toa",
}
PUBLIC_PARTY_KEYS = {
    "litigation_role": "tu_cach_to_tung",
    "full_name": "ho_ten",
    "birth_year": "nam_sinh",
    "citizen_id": "cccd",
    "address": "dia_chi",
}
ROW_HEADERS = [
    "LOẠI ÁN",
    "SỐ THỤ LÝ",
    "NGÀY THỤ LÝ (DD/MM/YYYY)",
    "QUAN HỆ PHÁP LUẬT",
    "TƯ CÁCH TỐ TỤNG",
    "HỌ TÊN ĐƯƠNG SỰ",
    "NĂM SINH",
    "CCCD",
    "ĐỊA CHỈ",
    "HỌ TÊN CHỦ TỌA",
    "GHI CHÚ",
]
VALID_ROLES = [
    "Bị cáo",
    "Bị hại",
    "Người bị hại",
    "Nguyên đơn",
    "Bị đơn",
    "Người có quyền lợi, nghĩa vụ liên quan",
    "Người liên quan",
    "Người làm chứng",
    "Đương sự",
]
CORRECTIONS = [
    ("TOÀ ÁN NHÂN DÂN", "TÒA ÁN NHÂN DÂN"),
    ("TÒA ÁN NHÂN DẦN", "TÒA ÁN NHÂN DÂN"),
    ("Độc lập - Tự đo - Hạnh phúc", "Độc lập - Tự do - Hạnh phúc"),
    ("NHÂN DÂNH", "NHÂN DANH"),
    ("NỘ1 DUNG VỤ ÁN", "NỘI DUNG VỤ ÁN"),
    ("NỘI DƯNG VỤ ÁN", "NỘI DUNG VỤ ÁN"),
    ("NỘI DUNG VỤ ÂN", "NỘI DUNG VỤ ÁN"),
    ("NỘI DUNG VU ÁN", "NỘI DUNG VỤ ÁN"),
    ("N0I DUNG VU AN", "NỘI DUNG VỤ ÁN"),
    ("NOI DUNG VU AN", "NỘI DUNG VỤ ÁN"),
    ("BỊ CÁ0", "BỊ CÁO"),
    ("bị cá0", "bị cáo"),
    ("Người có quyên lợi", "Người có quyền lợi"),
    ("nghĩa vu liên quan", "nghĩa vụ liên quan"),
    ("Thẩm phán - Chủ tọa phiên toà", "Thẩm phán - Chủ tọa phiên tòa"),
    ("Căn cưởc", "Căn cước"),
    ("Căn cước công dân số số", "Căn cước công dân số"),
]
MOJIBAKE_TEXT, MOJIBAKE_KEY = ["Ã", "áº", "á»", "Ä"], ["Ã", "áº", "á»"]

DATE_BREAKS = [("ngày", r"\d{1,2}", "tháng", r"\d{1,2}"), ("tháng", r"\d{1,2}", "năm", r"\d{4}")]
LINE_END, LIST_LINE, LOWER_START = r"[:;.?!]$", r"^\d+[.)]\s+", r"^\p{Ll}"
LIST_LEAD, LIST_ITEM, PARTY_LEAD = r"^\s*(?:gồm|bao gồm)\s*[:：]?\s*", r"(?:^|\n)\s*\d{1,2}\s*[.)]\s*", r"^\s*(?:gồm|là)\s*[:：]?\s*"
ROLE_NAMES = [
    ("bị cáo", "Bị cáo"),
    ("bị hại", "Bị hại"),
    ("quyền lợi", "Người có quyền lợi, nghĩa vụ liên quan"),
    ("liên quan", "Người có quyền lợi, nghĩa vụ liên quan"),
    ("làm chứng", "Người làm chứng"),
]
DATE_LONG = r"ngày\s+(\d{1,2})\s+tháng\s+(\d{1,2})\s+năm\s+(\d{4})"
DATE_SHORT = r"(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
DOCKET_LABEL = r"(?=[ts])(?:thụ\s*lý\s*số|số\s*thụ\s*lý)"
DOCKET_CODE = r"([0-9]{1,5}\s*/\s*[0-9]{4}\s*/\s*[A-ZĐ0-9/-]+)"
DOCKET = [
    DOCKET_LABEL + r"\s*[:：.]?\s*" + DOCKET_CODE,
    r"(?:vụ\s*án\s*hình\s*sự\s*)?thụ\s*lý\s*(?:sơ\s*thẩm\s*)?số\s*[:：.]?\s*" + DOCKET_CODE,
]
CASE_TYPES = [
    (r"(?=[HT])\b(?:HÌNH\s*SỰ|Hinh\s*su|HS-ST|HSST|TLST-HS|TLPT-HS)\b", "Hình sự"),
    (r"(?=[DT])(?:\bDÂN\s*SỰ|DS-ST|TLST-DS\b)", "Dân sự"),
    (r"(?=H)(?:\bHÔN\s*NHÂN|HNGĐ\b)", "Hôn nhân gia đình"),
    (r"(?=K)(?:\bKINH\s*DOANH|KDTM\b)", "Kinh doanh thương mại"),
    (r"(?=L)(?:\bLAO\s*ĐỘNG|LĐ-ST\b)", "Lao động"),
]
RELATIONS = [
    r"về\s+tội\s+[\"“”']?([^\"“”'\n;.]+)",
    r"tội\s+danh\s*[:：]\s*([^\n;.]+)",
    r"quan\s+hệ\s+pháp\s+luật\s*[:：]\s*([^\n;.]+)",
    r"V[/\\]v\s*[:：]?\s*([^\n;.]+)",
    r"về\s+việc\s*[:：]?\s*([^\n;.]+)",
]
JUDGES = [
    r"Thẩm\s*phán\s*[-–]\s*Chủ\s*tọa\s*phiên\s*tòa\s*[:：]\s*([^\n;]+)",
    r"Chủ\s*tọa\s*phiên\s*tòa\s*[:：]\s*([^\n;]+)",
    r"Thẩm\s*phán\s*chủ\s*tọa\s*[:：]\s*([^\n;]+)",
]
# Alternatives are tried only where one of their first letters stands.
ROLE_LABEL = (
    r"(?=[CBN])(?:Các bị cáo|Bị cáo|Người bị hại|Bị hại|"
    r"Người có quyền lợi[, ]+(?:và\s+)?nghĩa vụ liên quan|Người liên quan|Người làm chứng)"
)
NAME_END = (
    r"(?=[sgnqdđtchĐ])\b(?:sinh|SN|năm sinh|giới tính|nghề nghiệp|quốc tịch|dân tộc|địa chỉ|nơi cư trú|"
    r"trú tại|cư trú tại|HKTT|ĐKHKTT|CCCD|CMND|Căn cước|Chứng minh)\b"
)
NAME_LEAD = r"^\s*(?:gồm|là|ông|bà|anh|chị|bị cáo|bị hại)\s+"
HONORIFIC = r"^(?:Ông|Bà|Anh|Chị)\s+"
NAME_SHAPE = r"(?:ông|bà|anh|chị)?\s*([A-ZÀ-Ỵ][A-Za-zÀ-ỹ'.-]+(?:\s+[A-ZÀ-Ỵ][A-Za-zÀ-ỹ'.-]+){1,7})"
BIRTH_YEARS = [
    r"(?=[sn])(?:sinh\s*năm|năm\s*sinh|SN)\s*[:：]?\s*(\d{4})",
    r"sinh\s*ngày\s*\d{1,2}[/-]\d{1,2}[/-](\d{4})",
    r"sinh\s*ngày\s*\d{1,2}\s*tháng\s*\d{1,2}\s*năm\s*(\d{4})",
]
IDENTITY = (
    r"(?=[CS])(?:CCCD|CMND|Căn\s*cước\s*công\s*dân|Chứng\s*minh\s*nhân\s*dân|"
    r"số\s*định\s*danh\s*cá\s*nhân)\D{0,25}(\d(?:\D?\d){8}(?:\D?\d{3})?)"
)
ADDRESS_LABEL = (
    r"(?=[nđtcĐh])(?:nơi cư trú|nơi cư trú hiện nay|địa chỉ|trú tại|cư trú tại|"
    r"nơi đăng ký hộ khẩu thường trú|đăng ký hộ khẩu thường trú|ĐKHKTT|HKTT|"
    r"hộ khẩu thường trú|chỗ ở hiện nay|chỗ ở)"
)
ADDRESS_STOP = (
    r"\s*;\s*(?:nghề nghiệp|trình độ|dân tộc|quốc tịch|giới tính|con ông|con bà|"
    r"tiền án|tiền sự|nhân thân|bị bắt|bị tạm giữ|bị tạm giam|có mặt|vắng mặt|"
    r"CCCD|CMND|Căn cước|Chứng minh)\b"
)
NOT_A_NAME = [
    "có mặt", "vắng mặt", "tại phiên tòa", "phiên tòa", "được triệu tập", "bị bắt",
    "bị tạm giam", "bị tạm giữ", "người phiên dịch", "thư ký", "kiểm sát viên",
]
NO_JOIN_HEAD = r"^(?:Bị cáo|Bị hại|Người có quyền lợi|Thẩm phán|Hội thẩm|Kiểm sát viên|NỘI DUNG)"
DANGLING = r"\b(?:ngày|tháng|năm|sinh|trú|cư trú|địa chỉ)$"
# Letters of which a text has some, in lower case, wherever one of these patterns matches: they are looked for before.
CASE_TYPE_HINTS = [("hình", "hinh", "hs-st", "hsst", "t-hs"), ("dân", "ds-st", "tlst-ds"), ("hôn", "hngđ"), ("kinh", "kdtm"), ("động", "lđ-st")]
DOCKET_HINTS, DATE_HINTS, JUDGE_HINTS, ROLE_HINTS = ("thụ",), ("tháng",), ("chủ",), ("bị cáo", "bị hại", "người ")
RELATION_HINTS = [("tội",), ("tội",), ("luật",), ("v/v", "v\\v"), ("việc",)]
INLINE_HINTS = [("nội", "noi", "n0i"), ("dung", "dưng")]
SUSPICIOUS_NAME = r"\b(?:co mat|vang mat|phien toa|tai phien|duoc trieu tap|bi bat|tam giam)\b"
INLINE_MARKERS = [r"N[ỘO0]I\s+D[UƯ]NG\s+V[ỤU]\s+[ÁA]N\s*:?", r"NOI\s+DUNG\s+VU\s+AN\s*:?", r"N0I\s+DUNG\s+VU\s+AN\s*:?"]

RULES_ONLY = "Local LLM not available; rules only."
NO_MARKER = "Cần review: không tìm thấy marker NỘI DUNG VỤ ÁN trong phạm vi OCR."
MISSING_CASE = "Thiếu thông tin chung: "
BAD_DATE = "Ngày thụ lý không đúng DD/MM/YYYY: "
NO_EVIDENCE = "Cần review: field {} thiếu evidence_text từ model."
WRONG_EVIDENCE = "Cần review: evidence_text của field {} không khớp OCR text."
NO_PARTIES = "Không nhận diện được người tham gia tố tụng."
NO_PARTIES_NOTE = "Không nhận diện được người tham gia tố tụng"
LOW_CONFIDENCE_WARNING = "Cần review: có field confidence thấp hoặc thiếu căn cứ."
MISSING_PARTY = "Thiếu: "
ODD_ROLE = "Tư cách tố tụng cần kiểm tra: "
ODD_YEAR = "Năm sinh không phải 4 chữ số: "
ODD_IDENTITY = "CCCD/CMND không phải 9 hoặc 12 số."
CONFLICT = "Conflict giữa extractor ở field {}; chọn {} theo confidence."
WARNING_GROUPS = [
    ("khong tim thay marker", "missing_marker"),
    ("thieu thong tin chung", "missing_case_fields"),
    ("thieu", "missing_participant_fields"),
    ("confidence thap|can review", "needs_review_or_low_confidence"),
    ("local llm", "local_llm"),
]
STOP_REASONS = ("content_marker_found", "force_full_ocr_completed", "end_of_pdf_without_marker", "max_pages_before_content_marker_reached")
