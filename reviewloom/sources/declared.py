"""The declared sources and the export layout: parameters of the jobs, no logic.

All names, keys and paths in this module are fixed values: they are what the shop APIs send and
what the mapping tables and the export layout call their columns.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from reviewloom.functions.json import flat_key_map
from reviewloom.sources.dataset import Dataset

DAY_MS = 24 * 60 * 60 * 1000


@dataclass(frozen=True)
class Source:
    """One paged JSON source: where its records are, their key, and the key-to-column map."""

    name: str
    label: str
    record_path: tuple[str, ...]
    pk: str
    keys: Mapping[str, object]
    dataset: Dataset
    embedded_keys: tuple[str, ...] = ()
    term_limit_ms: int | None = None
    first_page: int = 0
    last_wins: bool = True

    def key_map(self) -> dict[str, str]:
        """Flat JSON key to physical column."""
        named = {}
        for key, target in self.keys.items():
            if isinstance(target, str):
                named[key] = self.dataset[target]
            else:
                named[key] = (self.dataset[target[0]], target[1])
        return flat_key_map(named)

    def pk_column(self) -> str:
        return self.key_map()[self.pk]


SOURCE_A_REVIEWS = Source(
    name="source_a",
    label="에이블리",
    record_path=("reviews",),
    pk="sno",
    keys={
        "sno": "REVIEW_ID",
        "updated_at": "REVIEW_CREATED_DATETIME",
        "contents": "REVIEW_CONTENTS",
        "size": "PRODUCT_SIZE",
        "images.{index}": ("URL_IMAGE", 10),
        "order_item_sno": "ORDER_ID",
        "goods.sno": "PRODUCT_ID",
    },
    dataset=Dataset(
        name="source_a reviews",
        columns={
            "REVIEW_ID": "리뷰_id",
            "REVIEW_CONTENTS": "리뷰_내용",
            "PRODUCT_ID": "상품_id",
            "REVIEW_CREATED_DATETIME": "리뷰_작성_일시",
            "URL_IMAGE": "URL_이미지",
            "ORDER_ID": "주문_id",
            "PRODUCT_SIZE": "사이즈",
        },
        required=frozenset({"REVIEW_ID", "REVIEW_CONTENTS", "PRODUCT_ID"}),
        arrays={"URL_IMAGE": 10},
    ),
)

SOURCE_A_ORDERS = Source(
    name="source_a",
    label="에이블리",
    record_path=("order_items",),
    pk="sno",
    keys={
        "sno": "ORDER_ID",
        "receiver_name": "RECEIVER_NAME",
        "receiver_addr": "RECEIVER_ADDR",
        "buyer_name": "BUYER_NAME",
        "buyer_tel": "BUYER_PHONE",
        "buyer_email": "BUYER_EMAIL",
        "goods_sno": "PRODUCT_ID",
        "goods_name": "GOODS_NAME",
        "goods_custom_code": "GOODS_CUSTOM_CODE",
        "option_info": "OPTION_INFO",
        "ordered_at": "ORDERED_AT",
    },
    dataset=Dataset(
        name="source_a orders",
        columns={
            "ORDER_ID": "주문_id",
            "PRODUCT_ID": "상품_id",
            "BUYER_NAME": "구매자명",
            "BUYER_PHONE": "구매자_번호",
            "BUYER_EMAIL": "구매자_이메일",
            "RECEIVER_NAME": "수취인명",
            "RECEIVER_ADDR": "수취인_주소",
            "GOODS_NAME": "판매명",
            "GOODS_CUSTOM_CODE": "상품_코드",
            "OPTION_INFO": "옵션_정보",
            "ORDERED_AT": "주문_일시",
        },
        required=frozenset({"ORDER_ID", "PRODUCT_ID"}),
    ),
    first_page=1,
    last_wins=False,
)

SOURCE_B_REVIEWS = Source(
    name="source_b",
    label="쿠팡",
    record_path=("data", "content"),
    pk="reviewId",
    keys={
        "reviewId": "REVIEW_ID",
        "reviewAt": "REVIEW_CREATED_DATETIME",
        "reviewTitle": "REVIEW_TITLE",
        "reviewContent": "REVIEW_CONTENTS",
        "rating": "REVIEW_STAR_RATING",
        "memberName": "REVIEW_WRITER_NAME",
        "attachment.imageAttachments.{index}.imgSrc": ("URL_IMAGE", 10),
        "productId": "PRODUCT_OPTION_ID",
        "itemName": "ITEM_NAME",
        "vendorItemId": "PRODUCT_ID",
    },
    dataset=Dataset(
        name="source_b reviews",
        columns={
            "REVIEW_ID": "리뷰_id",
            "REVIEW_CONTENTS": "리뷰_내용",
            "REVIEW_CREATED_DATETIME": "리뷰_작성_일시",
            "REVIEW_WRITER_NAME": "구매자명",
            "REVIEW_TITLE": "리뷰_제목",
            "REVIEW_STAR_RATING": "별점",
            "URL_IMAGE": "URL_이미지",
            "PRODUCT_ID": "상품_노출_id",
            "ITEM_NAME": "판매명",
            "PRODUCT_OPTION_ID": "상품_옵션_id",
        },
        required=frozenset({"REVIEW_ID", "REVIEW_CONTENTS", "PRODUCT_ID"}),
        arrays={"URL_IMAGE": 10},
    ),
    embedded_keys=("attachment",),
    term_limit_ms=30 * DAY_MS,
)

TARGET_REVIEWS = Source(
    name="target",
    label="브이리뷰",
    record_path=("results",),
    pk="id",
    keys={
        "id": "REVIEW_ID",
        "author_name": "REVIEW_WRITER_NAME",
        "text": "REVIEW_CONTENTS",
        "is_visible": "IS_VISIBLE",
        "created_at": "REVIEW_CREATED_DATETIME",
        "product.id": "PRODUCT_ID",
        "product.remote_id": "PRODUCT_REMOTE_ID",
        "product.name": "PRODUCT_NAME",
        "review_group.id": "REVIEW_GROUP_ID",
        "review_group.name": "REVIEW_GROUP_NAME",
        "questions.{index}.question": ("QUESTION", 10),
        "questions.{index}.answer": ("ANSWER", 10),
    },
    dataset=Dataset(
        name="target reviews",
        columns={
            "REVIEW_ID": "리뷰_id",
            "REVIEW_CONTENTS": "리뷰_내용",
            "REVIEW_CREATED_DATETIME": "리뷰_작성_일시",
            "REVIEW_WRITER_NAME": "작성자명",
            "PRODUCT_ID": "상품_내부_id",
            "IS_VISIBLE": "리뷰_노출_여부",
            "PRODUCT_REMOTE_ID": "상품_노출_id",
            "PRODUCT_NAME": "상품명",
            "REVIEW_GROUP_ID": "그룹_id",
            "REVIEW_GROUP_NAME": "그룹명",
            "QUESTION": "고객정보_정보명",
            "ANSWER": "고객정보_답변값",
        },
        required=frozenset({"REVIEW_ID", "REVIEW_CONTENTS", "PRODUCT_ID"}),
        arrays={"QUESTION": 10, "ANSWER": 10},
    ),
    term_limit_ms=365 * DAY_MS,
)

SOURCE_A_ID_MAP = Dataset(
    name="source_a id map",
    columns={"SCRAPING_PLATFORM_PRODUCT_ID": "에이블리_상품_id", "EXPORT_PLATFORM_PRODUCT_ID": "브이리뷰_상품_id"},
    required=frozenset({"SCRAPING_PLATFORM_PRODUCT_ID", "EXPORT_PLATFORM_PRODUCT_ID"}),
)

SOURCE_B_ID_MAP = Dataset(
    name="source_b id map",
    columns={"SCRAPING_PLATFORM_PRODUCT_ID": "노출상품ID", "EXPORT_PLATFORM_PRODUCT_ID": "브이리뷰_상품_id"},
    required=frozenset({"SCRAPING_PLATFORM_PRODUCT_ID", "EXPORT_PLATFORM_PRODUCT_ID"}),
)

TARGET_ID_MAP = Dataset(
    name="target id map",
    columns={"SCRAPING_PLATFORM_PRODUCT_ID": "상품_id", "EXPORT_PLATFORM_PRODUCT_ID": "브이리뷰_상품_id"},
    required=frozenset({"SCRAPING_PLATFORM_PRODUCT_ID", "EXPORT_PLATFORM_PRODUCT_ID"}),
)

OPTION_MAP = Dataset(
    name="option map",
    columns={
        "EXPORT_PLATFORM_PRODUCT_ID": "브이리뷰_상품_id",
        "PRODUCT_NAME": "상품명",
        "PRODUCT_OPTION_NAME": "옵션명",
    },
    required=frozenset({"EXPORT_PLATFORM_PRODUCT_ID"}),
)

EXPORT_LAYOUT = Dataset(
    name="export",
    columns={
        "REVIEW_ID": "리뷰_id",
        "PRODUCT_ID": "상품_id",
        "REVIEW_CREATED_DATE": "리뷰_작성_일자",
        "REVIEW_CREATED_TIME": "리뷰_작성_시간",
        "REVIEW_WRITER_NAME": "리뷰_작성자명",
        "REVIEW_TITLE": "리뷰_제목",
        "REVIEW_CONTENTS": "리뷰_내용",
        "REVIEW_STAR_RATING": "리뷰_별점",
        "MANAGER_COMMENT": "관리자_댓글",
        "PRODUCT_OPTION_NAME": "구매옵션_옵션명",
        "PRODUCT_OPTION_VALUE": "구매옵션_옵션값",
        "CUSTOMER_ATTRIBUTE_NAME": "고객정보_정보명",
        "CUSTOMER_ATTRIBUTE_VALUE": "고객정보_답변값",
        "URL_IMAGE": "URL_이미지",
        "URL_VIDEO": "URL_동영상",
    },
    arrays={
        "PRODUCT_OPTION_NAME": 10,
        "PRODUCT_OPTION_VALUE": 10,
        "CUSTOMER_ATTRIBUTE_NAME": 10,
        "CUSTOMER_ATTRIBUTE_VALUE": 10,
        "URL_IMAGE": 10,
        "URL_VIDEO": 10,
    },
)

# The first customer attribute says where the review was bought.
BUYER_LABEL_NAME = "구매처"
BUYER_LABEL_VALUE = "{label} 구매자 리뷰입니다."
