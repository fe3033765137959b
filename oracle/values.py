"""Literal values of the oracle, stated apart from the library's so that a
wrong value there shows as a difference."""

# --- FIXED VALUES -------------------------------------------------------------
# (major, middle, names mapped to it)
CATEGORY_GROUPS = [
    ("WEB", "서버/백엔드 개발자", ["서버 개발자", "자바 개발자", "Node.js 개발자", "PHP 개발자", "웹 개발자", "루비온레일즈 개발자", ".NET 개발자", "백엔드 개발", "웹개발", "BACKEND_DEVELOPER", "서버/백엔드 개발자", "웹 풀스택 개발자"]),
    ("WEB", "프론트엔드 개발자", ["프론트엔드 개발자", "프론트엔드 개발", "FRONTEND_DEVELOPER"]),
    ("WEB", "웹 퍼블리셔", ["웹 퍼블리셔", "웹퍼블리셔"]),
    ("GAME", "게임 개발자", ["게임개발", "게임 클라이언트 개발자", "게임 서버 개발자"]),
    ("GAME", "VR/AR/3D", ["VR 엔지니어", "그래픽스 엔지니어", "VR/AR/3D,게임 클라이언트 개발자"]),
    ("DATA", "데이터 사이언티스트", ["데이터 사이언티스트", "DATA_SCIENTIST"]),
    ("DATA", "데이터 엔지니어", ["데이터 엔지니어", "빅데이터 엔지니어", "DATA_ENGINEER"]),
    ("DATA", "데이터 분석가", ["BI 엔지니어", "데이터 분석가", "DATA_ANALYST"]),
    ("DATA", "AI 엔지니어", ["머신러닝 엔지니어", "영상,음성 엔지니어", "MACHINE_LEARNING", "인공지능/머신러닝"]),
    ("DATA", "DBA", ["DBA", "빅데이터 엔지니어,DBA"]),
    ("MOBILE", "안드로이드 개발자", ["안드로이드 개발자", "안드로이드 개발", "ANDROID_DEVELOPER"]),
    ("MOBILE", "iOS 개발자", ["iOS 개발자", "iOS", "IOS_DEVELOPER", "IOS 개발자"]),
    ("MOBILE", "크로스 플랫폼 모바일 개발자", ["크로스플랫폼 앱 개발자", "크로스플랫폼 앱개발자", "CROSS_PLATFORM_DEVELOPER"]),
    ("SUPPORT", "PM", ["개발 매니저", "프로덕트 매니저", "AGILE_SCRUM_MASTER", "인공지능/머신러닝,개발 PM"]),
    ("SUPPORT", "QA 엔지니어", ["QA,테스트 엔지니어", "QA", "QA_ENGINEER", "QA 엔지니어"]),
    ("SUPPORT", "기술지원", ["기술지원", "SUPPORT_ENGINEER"]),
    ("DEVSECOPS", "데브옵스/인프라 엔지니어", ["DevOps / 시스템 관리자", "시스템,네트워크 관리자", "네트워크/보안/운영", "클라우드 개발", "DEV_OPS", "INFRA_ENGINEER", "devops/시스템 엔지니어"]),
    ("DEVSECOPS", "정보보안 담당자", ["보안 엔지니어", "CIO,Chief Information Officer", "SECURITY_ENGINEER", "정보보안 담당자"]),
    ("SW/HW/IOT", "HW/임베디드 개발자", ["임베디드 개발자", "하드웨어 엔지니어", "하드웨어 개발", "HARDWARE_EMBEDDED_ENGINEER", "HW/임베디드"]),
    ("SW/HW/IOT", "소프트웨어 개발자", ["소프트웨어 엔지니어", "파이썬 개발자", "C,C++ 개발자", "소프트웨어 개발", "소프트웨어아키텍트", "SOFTWARE_ENGINEER", "SW/솔루션"]),
    ("ETC", "블록체인 엔지니어", ["블록체인 플랫폼 엔지니어", "BLOCKCHAIN_ENGINEER", "프론트엔드 개발자,블록체인"]),
    ("ETC", "기타", ["ERP전문가", "CTO,Chief Technology Officer", "CTO", "ERP", "etc"]),
]
# Names without spaces that the exploratory dictionary has besides these.
LOOSE_EXTRA = [("블록체인엔지니어", "ETC", "블록체인 엔지니어")]
URL_PREFIX = {
    "wanted": "https://www.wanted.co.kr/wd/",
    "jumpit": "https://www.jumpit.co.kr/position/",
    "rallit": "https://www.rallit.com/positions/",
    "jobplanet": "https://jobplanet.co.kr/job/search?posting_ids%5B%5D=",
}
POSTING_ADDRESSES = [
    ("서울 강남구", 37.4979, 127.0276),
    ("부산", 35.1796, 129.0756),
    ("서울  마포구", 37.5663, 126.9019),
]
PART_TYPE_TAXONOMY = [
    ("RETAIL", "SMALL GOODS", "SMALL"),
    ("RETAIL", "SMALL GOODS", "PROMO"),
    ("RETAIL", "BUDGET", "ECONOMY"),
    ("BULK", "BIG GOODS", "LARGE"),
    ("BULK", "BIG GOODS", "STANDARD"),
]
# -----------------------------------------------------------------------------


def taxonomy_rows():
    return [(major, middle, name) for major, middle, names in CATEGORY_GROUPS for name in names]


def loose_taxonomy_rows():
    known = {name.replace(" ", ""): (major, middle) for major, middle, name in taxonomy_rows()}
    return [(k, *v) for k, v in known.items()] + LOOSE_EXTRA
