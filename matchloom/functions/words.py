"""Word lists of the Korean keyword rules."""

from __future__ import annotations

# Word lists that keyword results depend on, in their given order, and names of places, forms and absences.
STOP_WORDS = tuple(
    """기타 제조업 제품 사업 회사 업체 관련 서비스 제조 판매 생산 개발 기술 산업 업무 운영 관리 지원 제공 이용 사용 활용 처리 수행
    분야 부문 종류 형태 방식 방법 과정 절차 대상 범위 내용 항목 종목 품목 물품 물자 시설 설비 장비 기기 기계 장치 도구 용품
    자재 재료 원료 부품 소재 물질 성분 요소 구조 형식 유형 종별 구분 분류 목록 도매업 부대 일체 일반 임대업 판매업 상기
    각호 공급 호에 서비스업 소매업 부동산 제작 매매 전문 응용 목적 대행업 신품 공업 소매 가공 상거래 도매 형성 경영 유지
    기자재 단계 용역 특수 작업 유사 조립 대행 가공업 무역업 위 각항 부대되는 사업일체 실시 진행 추진 시행 완료 종료 시작 착수
    설립 설치 구축 도입 적용 반영 포함 제외 및 외 내 중 상 하 전 후 등 것 수""".split()
)
CONNECTIVES = tuple(
    """관련된 관련되 위한 통한 대한 관한 따른 인한 위해 통해 위하여 하는 되는 있는 없는 같은 하고 되고 하며 되며 해서 하여 되어 하면 되면
    또는 혹은 그리고 하지만 그러나 따라서 그래서 해당하는 필요한 가능한 부대하는 속하는 부대되는""".split()
)
TRADE_SUFFIXES = tuple("판매업 도매업 소매업 서비스업 제조업 생산업 가공업 임대업 대행업 무역업 유통업 공업 업".split())
PARTICLES = tuple("으로서 으로써 에서의 에게서 에서 에게 으로 와의 과의 에의 에 의 을 를".split())
VERB_ENDINGS = tuple("하여 하는 되어 되는 한 해 된 되 함 됨".split())
BOILERPLATE = tuple("특징 상기 것을 것 포함하는 그것".split())
#: Legal forms of companies, as they stand in names.
LEGAL_FORMS = ("(주)", "(株)", "㈜", "주식회사", "(유)", "유한회사", "(재)", "재단법인", "(사)", "사단법인", "농업회사법인", "(농)")
#: Those taken off where case is kept, in their order; spaces go first.
COMMON_LEGAL_FORMS = (" ", "(주)", "㈜", "주식회사")
#: Particles taken off the end of a token, the first that fits.
TAIL_PARTICLES = tuple("으로 는 은 와 과 이 가 을 를 의 도 로".split())
COUNTRIES = {"KR": "한국", "US": "미국", "CN": "중국", "JP": "일본", "EP": "유럽", "XU": "유럽", "XI": "PCT", "WO": "PCT"}
REGION_GROUPS = {"수도권": ("서울", "경기", "인천"), "충청권": ("충남", "충북", "대전", "세종"), "호남권": ("전북", "전남", "광주"), "영남권": ("경남", "경북", "대구", "부산"), "강원권": ("강원",)}
#: A region that is similar to none but itself.
ALONE = "강원"
#: Words that tell of missing information.
ABSENCE = (
    r"(제공되지\s*않|정보[가는은]\s*없|해당\s*(내용|정보|사례)\S*\s*생략|생략(합니다|한다|됩니다|됨|하)|분석할\s*수\s*없|작성할\s*수\s*없|활용되지\s*않|"
    r"수행\s*기업[이가]?\s*(존재하지\s*않|없)|존재하지\s*않|확인되지\s*않|conduct_list_company)"
)
# Patterns by which descriptions, texts and answers are read, in order of preference.
SUBJECT_PHRASES = (
    r"[,，]\s*([가-힣][가-힣·.\s]*?)\s*분야에\s*(?:속|해당)",
    r"수행(?:하며|했으며|하는 이 과제는|한 이 과제는)?\s*([가-힣][가-힣·.\s]{1,18}?)\s*분야에\s*(?:속|해당)",
    r"이 과제는\s*([가-힣][가-힣·.\s]{1,18}?)\s*분야에\s*(?:속|해당)",
    r"에서는?\s*([가-힣][가-힣·.\s]{1,18}?)\s*분야(?:의|에서)",
    r"[는은]\s*([가-힣][가-힣·.\s]{1,18}?)\s*분야(?:에서|의|에\s*속|에\s*해당)",
    r"([가-힣][가-힣·.\s]{1,18}?)\s*분야에\s*(?:속|해당)",
)
NO_SUBJECT = "과제|수행|연구비|총연구"
PERIOD = r"(\d{4})년\s*\d{1,2}월\s*\d{1,2}일에 시작.*?(\d{4})년\s*\d{1,2}월\s*\d{1,2}일에 종료"
FIRST_YEAR = r"(\d{4})년"
SENTENCE_GAP = r"([가-힣%)\]』」’”])\.(?=[^\s.,;:)\]\}%’”」』])"
SOURCE_TAG = r"\s*\(출처[:：][^)]*\)\s*$"
SCORE_ITEM = r'\{\s*"id"\s*:\s*(\d+)\s*,\s*"score"\s*:\s*(\d+)\s*,\s*"reason"\s*:\s*"([^"]*)"'
