"""The warehouse layers composed from the operators, over one set of entity frames."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from orderloom.operators import dims, orders, wide
from orderloom.sources.mapping import AS_OF_YEAR, Shop


class Warehouse:
    def __init__(self, shop: Shop, as_of_year: int = AS_OF_YEAR):
        self.shop = shop
        self.as_of_year = as_of_year

    @cached_property
    def users(self) -> DataFrame:
        return dims.user_info(self.shop.user_source, self.as_of_year)

    @cached_property
    def product(self) -> DataFrame:
        shop = self.shop
        return dims.product(shop.sku, shop.spu, shop.trademark, shop.category3)

    @cached_property
    def base_orders(self) -> DataFrame:
        """Orders with time fields, without province."""
        return orders.with_time_fields(self.shop.order_base)

    @cached_property
    def timed_orders(self) -> DataFrame:
        return orders.with_time_fields(self.shop.order_source)

    def labelled(self, timed: DataFrame) -> DataFrame:
        """First-order flag, province and user labels on orders."""
        first_ids = orders.first_order_ids(self.shop.order_base)
        flagged = orders.flag_first_orders(timed, first_ids)
        return orders.enrich_orders(flagged, self.shop.province, self.users)

    @cached_property
    def orders(self) -> DataFrame:
        return self.labelled(self.timed_orders)

    @cached_property
    def details(self) -> DataFrame:
        return orders.enrich_details(self.shop.detail_source, self.product)

    @cached_property
    def bare_details(self) -> DataFrame:
        return orders.without_product(self.shop.detail_source)

    def wide_for(self, timed: DataFrame, details: DataFrame) -> DataFrame:
        """Fully labelled wide rows of the given orders."""
        summed = wide.attach_sums(timed, self.shop.detail_source)
        return wide.order_wide(self.labelled(summed), details)

    @cached_property
    def wide(self) -> DataFrame:
        return self.wide_for(self.timed_orders, self.details)

    def plain_wide(self, details: DataFrame, scale: int = 2) -> DataFrame:
        """Wide rows without order labels, over lines enriched or not."""
        summed = wide.attach_sums(self.base_orders, self.shop.detail_source, scale)
        return wide.order_wide(orders.without_labels(summed), details, scale)
