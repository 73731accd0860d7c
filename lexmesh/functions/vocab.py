"""Closed vocabularies and rule tables of the statute network."""

from __future__ import annotations

# Node labels, in the order of lookups, and the subtype column of each.
NODE_LABELS = {"Organization": "category", "Person": "role_hint", "LegalDocument": "doc_type", "Concept": "concept_type"}

# Edge types by category.
EDGE_CATEGORIES = {
    "인사/직위": ["APPOINTS", "DISMISSES", "RESIGNS", "WORKS_AT", "DELEGATES_TO"],
    "설립/폐지/조직변경": ["ESTABLISHES", "DISSOLVES", "MERGES_WITH", "DIVIDES_INTO", "CONVERTS_TO"],
    "소통/보고/공시": ["NOTIFIES", "SUBMITS", "DISCLOSES", "REGISTERS", "REQUESTS", "RECORDS"],
    "승인/결정": ["APPROVES", "REJECTS", "DELIBERATES"],
    "위반/제재": ["VIOLATES", "COMPLIES", "SANCTIONS", "RESTRICTS", "EXEMPTS"],
    "재산/거래/자금": ["ACQUIRES", "DISPOSES", "HOLDS", "INVESTS", "ISSUES", "TRANSACTS_WITH", "PAYS", "BORROWS", "LENDS", "GUARANTEES", "ENTRUSTS_ASSET", "CALCULATES"],
    "관리/운영/수행": ["MANAGES", "USES", "PERFORMS", "PROTECTS", "SUPPORTS"],
    "판단/심사/감독": ["REVIEWS", "SUPERVISES", "EVALUATES"],
    "법제/규정": ["PRESCRIBES", "ENACTS", "AMENDS", "ENFORCES", "APPLIES_LAW", "EXCLUDES", "DELETES_PROVISION"],
    "상태전이": ["OCCURS", "EXPIRES", "TERMINATES", "COMMENCES", "CONTINUES"],
    "기준비교": ["SATISFIES", "EXCEEDS", "FALLS_SHORT_OF"],
    "기타": ["AFFECTS", "DENIES", "CONVENES", "GRANTS", "LOSES"],
}
EDGE_TYPES = [t for types in EDGE_CATEGORIES.values() for t in types]

# Keywords of a question and the edge types that they hint at.
KEYWORDS = {
    "임명": ["APPOINTS", "DISMISSES", "WORKS_AT", "DELEGATES_TO"],
    "선임": ["APPOINTS", "DISMISSES"],
    "해임": ["DISMISSES", "APPOINTS", "RESIGNS"],
    "사임": ["RESIGNS", "DISMISSES"],
    "위임": ["DELEGATES_TO", "APPOINTS"],
    "위탁": ["DELEGATES_TO", "ENTRUSTS_ASSET"],
    "재직": ["WORKS_AT"],
    "근무": ["WORKS_AT"],
    "설립": ["ESTABLISHES", "DISSOLVES"],
    "해산": ["DISSOLVES", "ESTABLISHES"],
    "합병": ["MERGES_WITH"],
    "분할": ["DIVIDES_INTO"],
    "전환": ["CONVERTS_TO"],
    "보고": ["NOTIFIES", "SUBMITS", "RECORDS"],
    "통지": ["NOTIFIES"],
    "제출": ["SUBMITS", "NOTIFIES", "RECORDS"],
    "공시": ["DISCLOSES"],
    "공고": ["DISCLOSES"],
    "신고": ["REGISTERS", "NOTIFIES"],
    "등록": ["REGISTERS"],
    "요청": ["REQUESTS"],
    "요구": ["REQUESTS"],
    "기재": ["RECORDS"],
    "승인": ["APPROVES", "REJECTS"],
    "인가": ["APPROVES", "REJECTS"],
    "거부": ["REJECTS", "APPROVES"],
    "거절": ["REJECTS"],
    "의결": ["DELIBERATES", "APPROVES"],
    "심의": ["DELIBERATES"],
    "결정": ["DELIBERATES"],
    "위반": ["VIOLATES", "COMPLIES", "SANCTIONS"],
    "준수": ["COMPLIES", "VIOLATES"],
    "제재": ["SANCTIONS", "RESTRICTS", "VIOLATES"],
    "처분": ["SANCTIONS", "DISPOSES"],
    "금지": ["RESTRICTS", "EXEMPTS"],
    "제한": ["RESTRICTS", "EXEMPTS"],
    "면제": ["EXEMPTS", "RESTRICTS"],
    "취득": ["ACQUIRES", "DISPOSES"],
    "매도": ["DISPOSES", "ACQUIRES"],
    "양도": ["DISPOSES"],
    "보유": ["HOLDS", "INVESTS"],
    "소유": ["HOLDS"],
    "투자": ["INVESTS", "ACQUIRES"],
    "출자": ["INVESTS"],
    "발행": ["ISSUES"],
    "상장": ["ISSUES"],
    "거래": ["TRANSACTS_WITH"],
    "매매": ["TRANSACTS_WITH"],
    "지급": ["PAYS"],
    "납부": ["PAYS"],
    "차입": ["BORROWS", "LENDS"],
    "대출": ["LENDS", "BORROWS"],
    "여신": ["LENDS"],
    "보증": ["GUARANTEES"],
    "신탁": ["ENTRUSTS_ASSET"],
    "예탁": ["ENTRUSTS_ASSET"],
    "산정": ["CALCULATES"],
    "계산": ["CALCULATES"],
    "관리": ["MANAGES", "SUPERVISES"],
    "운영": ["MANAGES", "USES"],
    "경영": ["MANAGES"],
    "이용": ["USES"],
    "수행": ["PERFORMS"],
    "이행": ["PERFORMS"],
    "보호": ["PROTECTS"],
    "방지": ["PROTECTS"],
    "지원": ["SUPPORTS"],
    "검토": ["REVIEWS"],
    "심사": ["REVIEWS", "DELIBERATES"],
    "조사": ["REVIEWS"],
    "검사": ["REVIEWS", "SUPERVISES"],
    "감독": ["SUPERVISES"],
    "감사": ["SUPERVISES", "REVIEWS"],
    "평가": ["EVALUATES"],
    "인정": ["EVALUATES"],
    "규정": ["PRESCRIBES"],
    "정한다": ["PRESCRIBES"],
    "제정": ["ENACTS"],
    "개정": ["AMENDS"],
    "시행": ["ENFORCES"],
    "적용": ["APPLIES_LAW", "EXCLUDES"],
    "제외": ["EXCLUDES", "APPLIES_LAW"],
    "삭제": ["DELETES_PROVISION"],
    "발생": ["OCCURS"],
    "만료": ["EXPIRES"],
    "종료": ["TERMINATES"],
    "해지": ["TERMINATES"],
    "개시": ["COMMENCES"],
    "계속": ["CONTINUES"],
    "충족": ["SATISFIES", "FALLS_SHORT_OF"],
    "초과": ["EXCEEDS"],
    "미달": ["FALLS_SHORT_OF"],
    "소집": ["CONVENES"],
    "개최": ["CONVENES"],
    "부여": ["GRANTS"],
    "상실": ["LOSES"],
}

# Short and former names.
ALIASES = {
    "금융위": "금융위원회",
    "금융감독위원회": "금융위원회",
    "감독위원회": "금융위원회",
    "금감원": "금융감독원",
    "감독원": "금융감독원",
    "한은": "한국은행",
    "예보": "예금보험공사",
    "공정위": "공정거래위원회",
}

# Filler glued before a canonical name, and the names it is cut from.
JUNK_PREFIXES = ["해당기간동안", "기간동안", "경우등", "경우", "기간등", "보완기간등", "사람등", "정보통신망이용등", "명칭등", "여부등", "청산대상거래등", "증권등", "자산비율등", "행위등", "공동사용금지등", "거래조건기타", "취득가격기타", "자구수정등", "내용등", "이상", "때", "등"]
CANONICAL = ["금융위원회", "금융감독원", "한국은행", "감사원", "금융정보분석원", "공정거래위원회", "예금보험공사", "한국거래소", "한국자산관리공사", "한국산업은행", "중소기업은행"]

# Suffixes that type a name; the order is that of the tests.
NOT_LAWS = ["위법", "불법", "준법", "탈법", "무법", "편법", "합법"]
LAW_SUFFIXES = ["법률", "시행령", "시행규칙", "감사원규칙", "고시", "훈령", "예규", "법"]
PERSON_SUFFIXES = [
    "위원장", "이사장", "대표이사", "사외이사", "상근감사", "감사위원", "임직원", "위원", "이사", "감사", "임원", "직원", "근로자", "대리인", "수탁자", "신고자", "소비자", "채권자", "채무자",
    "원장", "청장", "처장", "장관", "대통령", "총재", "총장", "행장", "회장", "사장", "부사장", "전무", "상무", "본부장", "지점장", "책임자", "관리자", "담당자", "대리", "검사역", "심사역",
    "조사역", "청문감사인", "준법감시인", "내부감사인", "선임계리사", "계리사", "회계사", "변호사", "발기인", "청산인", "파산관재인", "관리인", "보증인", "대표자", "발행인", "인수인", "매수인", "매도인",
    "임차인", "임대인", "이해관계인", "주주", "출자자", "투자자", "예금자", "가입자", "피보험자", "보험계약자", "수익자", "위탁자", "당사자", "신청인", "청구인",
]
ORG_SUFFIXES = [
    "금융지주회사", "지주회사", "저축은행", "종합금융회사", "여신전문금융회사", "자산운용회사", "자산운용사", "보험회사", "증권회사", "은행", "보험사", "증권사", "캐피탈", "카드사", "신탁회사", "위원회",
    "이사회", "총회", "협의회", "심의회", "공사", "공단", "협회", "연합회", "조합", "금고", "기금", "센터", "기관", "단체", "법인", "그룹", "회사", "본부", "청",
]
CONCEPT_SUFFIXES = [
    "내부통제", "지배구조", "자기자본", "신용정보", "금융투자상품", "금융상품", "집합투자증권", "집합투자기구", "위험관리", "리스크관리", "리스크", "제도", "기준", "원칙", "절차", "체계", "정책", "계획",
    "전략", "채권", "주식", "펀드", "신탁재산", "자산", "부채", "자본금", "손익", "수익", "비용", "정보",
]

# Endings that a verb's root is freed from; tags and forms of the clause rules.
ROOT_SUFFIXES = ["시키다", "드리다", "받다", "되다", "하다"]
NP_TAGS = ["NNG", "NNP", "XR", "SN", "SL"]
MODAL_STEMS = ["있", "없", "되", "아니", "못하", "말"]
