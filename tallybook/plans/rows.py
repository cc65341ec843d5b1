"""From classified rows to typed records: one select per domain with the first failed check as the row's reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions import dates, money, text
from tallybook.vocabulary import CATEGORIES, UNITS

ID = ["book", "sheet_index", "row_num"]


class Cells(text.Stage):
    """A stage with the cells of a row: each text is taken from the row once."""

    def __init__(self, rows: DataFrame):
        super().__init__(rows)
        self._raw: dict[tuple[str, str], Column] = {}
        self._texts: dict[str, Column] = {}

    def raw(self, field: str, part: str = "s") -> Column:
        """A cell's text or kind, taken from the row at the first level, so that no other carries its cells."""
        if (field, part) not in self._raw:
            self._raw[field, part] = self.bind(F.col("cells")[field][part])
        return self._raw[field, part]

    def text(self, field: str) -> Column:
        """The cell's text, trimmed and with single blanks; empty where there is none."""
        if field not in self._texts:
            self._texts[field] = self.bind_clean(self.raw(field))
        return self._texts[field]

    def filled(self, field: str) -> Column:
        return self.text(field) != ""

    def amount(self, field: str, parser=money.money) -> Column:
        """A money or quantity struct; a truth value in the cell is bad whatever its text."""
        return parser(self.bind(F.when(F.col("cells")[field]["kind"] == "b", "?").otherwise(F.col("cells")[field]["s"])))

    def optional(self, field: str, parser=money.money) -> Column:
        return F.when(self.filled(field), self.amount(field, parser))

    def document(self, field: str, domain: str) -> tuple[Column, Column]:
        """The number and why it can't be read."""
        number = self.bind(text.document(self.text(field), domain))
        return number, F.when(~self.filled(field), "MISSING_FIELD").when(number.isNull(), "BAD_CODE")

    def product(self) -> tuple[dict[str, Column], Column]:
        """Code and description key, and why there is neither."""
        code, key = self.bind(text.sku(self.text("sku"))), self.bind(F.when(~self.filled("sku"), text.description_key(self.raw("description"))))  # asked for only without a code
        reason = F.when(self.filled("sku"), F.when(code.isNull(), "BAD_CODE")).when(key.isNull(), "MISSING_FIELD")
        return {"sku": code, "description_key": key}, reason

    def finish(self, reasons: list[Column], values: dict[str, Column]) -> DataFrame:
        return self.rows().select(*ID, F.coalesce(*reasons).alias("reason"), *[v.alias(k) for k, v in values.items()])


def preview(cells: Column, fields: Column, most: int = 140) -> Column:
    """The cells of a row as ``field: text; ...`` in the order of the columns, blanks left out, cut to ``most`` characters."""
    texts = F.transform(fields, lambda f: F.struct(f.alias("f"), text.clean(F.try_element_at(cells, f)["s"]).alias("s")))
    shown = F.array_join(F.transform(F.filter(texts, lambda x: x["s"] != ""), lambda x: F.concat(x["f"], F.lit(": "), x["s"])), "; ")
    return text.let(shown, lambda s: F.when(F.length(s) > most, F.concat(F.substring(s, 1, most - 3), F.lit("..."))).otherwise(s))


def date_token() -> Column:
    cell = F.try_element_at(F.col("cells"), F.lit("date"))
    kind, s = cell["kind"], cell["s"]
    return (
        F.when(kind == "d", F.struct(s.try_cast("date").alias("value"), F.lit("excel_date").alias("method"), F.lit(None).cast("date").alias("day_first"), F.lit(None).cast("date").alias("month_first")))
        .when(kind == "b", dates.tokenize(F.lit("?")))
        .when(kind == "n", dates.serial(s.try_cast("double")))
        .otherwise(dates.tokenize(s))
    )


def with_dates(rows: DataFrame) -> DataFrame:
    """Data rows of dated domains with date, date_method and date_reason; conventions count data rows of the sheet and the book."""
    start, end = dates.valid_range(F.col("year"))
    read = text.staged(rows.withColumns({"range_start": start, "range_end": end}), __token=date_token)
    return dates.resolve_dates(read, "__token", sheet="sheet_index").drop("__token", "range_start", "range_end")


def _money_line(row: Cells) -> tuple[list[Column], dict[str, Column]]:
    quantity, amount, price = row.amount("quantity", money.quantity), row.amount("amount"), row.optional("unit_price")
    hint = row.bind(F.coalesce(F.col("hints")["amount"], F.col("hints")["unit_price"]))
    currency = money.resolve_currency(row.text("currency"), amount["currency"], price["currency"], hint)
    q, a, p = quantity["quantity"], amount["amount"], price["amount"]
    reasons = [
        quantity["reason"], F.when(q <= 0, "BAD_QUANTITY"), amount["reason"], F.when(a <= 0, "BAD_AMOUNT"), price["reason"], currency["reason"],
        F.when(~money.within_tolerance(a, q.cast("decimal(18,4)"), p.cast("decimal(18,4)")), "AMOUNT_MISMATCH"),
    ]
    values = {
        "quantity": q, "unit_price": F.coalesce(p.cast("decimal(18,4)"), F.when(q > 0, money.implied_price(a, q))), "amount": a,
        "currency": currency["currency"], "currency_source": currency["source"],
    }
    return reasons, values


def purchases(rows: DataFrame) -> DataFrame:
    with Cells(rows) as row:
        number, bad_number = row.document("po_number", "purchases")
        product, bad_product = row.product()
        reasons, values = _money_line(row)
        before = [bad_number, F.when(~row.filled("supplier"), "MISSING_FIELD"), bad_product, F.col("date_reason")]
        head = {"po_number": number, "supplier_raw": row.text("supplier"), "order_date": F.col("date"), "date_method": F.col("date_method")}
    return row.finish(before + reasons, head | product | values)


def sales(rows: DataFrame) -> DataFrame:
    with Cells(rows) as row:
        number, bad_number = row.document("receipt_no", "sales")
        channel = row.bind(text.channel(row.text("channel")))
        product, bad_product = row.product()
        reasons, values = _money_line(row)
        before = [bad_number, F.when(~row.filled("channel"), "MISSING_FIELD").when(channel.isNull(), "UNKNOWN_CHANNEL"), bad_product, F.col("date_reason")]
        head = {"receipt_no": number, "sale_date": F.col("date"), "date_method": F.col("date_method"), "channel": channel}
    return row.finish(before + reasons, head | product | values)


def movements(rows: DataFrame) -> DataFrame:
    with Cells(rows) as row:
        number, bad_number = row.document("voucher_no", "inventory")
        product, bad_product = row.product()
        kind = row.bind(text.movement_type(row.text("movement_type")))
        into, out_of, one = row.optional("qty_in", money.quantity), row.optional("qty_out", money.quantity), row.amount("quantity", money.quantity)
        got_in, got_out = (F.coalesce(x["quantity"], F.lit(0).cast(money.DECIMAL)) for x in (into, out_of))
        pair = row.bind(F.array_contains("fields", "qty_in"))
        two = F.coalesce(into["reason"], out_of["reason"], F.when(((got_in != 0) & (got_out != 0)) | ((got_in == 0) & (got_out == 0)) | (got_in < 0) | (got_out < 0), "BAD_QUANTITY"))
        typed = row.bind(F.when(pair, F.when(got_in != 0, got_in).otherwise(-got_out)).otherwise(one["quantity"]))
        quantity = F.when(kind.isin("receipt", "production"), F.abs(typed)).when(kind.isin("issue", "sale"), -F.abs(typed)).otherwise(typed)
        reference = F.nullif(row.text("reference"), F.lit(""))
        order = row.bind(text.document(row.text("reference"), "purchases"))
    reasons = [bad_number, bad_product, F.when(kind.isNull(), "UNKNOWN_MOVEMENT_TYPE"), F.col("date_reason"), F.when(pair, two).otherwise(one["reason"]), F.when(typed == 0, "BAD_QUANTITY")]
    values = {
        "voucher_no": number, "movement_date": F.col("date"), "date_method": F.col("date_method"), **product, "movement_type": kind, "quantity": quantity, "reference": reference,
        "po_number": F.when(kind == "receipt", order),
    }
    return row.finish(reasons, values)


def payroll(rows: DataFrame) -> DataFrame:
    with Cells(rows) as row:
        period = row.bind(dates.parse_period(F.col("sheet"), F.col("year")))
        code = row.bind(text.employee(row.text("employee_code")))
        cash = {f: row.amount(f) for f in ("gross", "deductions", "net")}
        key = row.bind(text.name_key(row.text("name")))
        filled, named, position = row.filled("employee_code"), row.filled("name"), F.nullif(row.text("position"), F.lit(""))
    gross, deductions, net = (c["amount"] for c in cash.values())
    each = []
    for c in cash.values():
        each += [c["reason"], F.when(c["currency"] != "RWF", "CURRENCY_CONFLICT")]
    reasons = [
        F.when(period.isNull(), "BAD_PERIOD"), F.when(filled & code.isNull(), "BAD_CODE"), F.when(~named, "MISSING_FIELD"), *each,
        F.when((gross <= 0) | (deductions < 0), "BAD_AMOUNT"), F.when(net != gross - deductions, "NET_MISMATCH"),
    ]
    values = {"period": period, "employee_code": F.when(filled, code), "name_raw": row.text("name"), "name_key": key, "position": position, "gross": gross, "deductions": deductions, "net": net}
    return row.finish(reasons, values)


def products(rows: DataFrame) -> DataFrame:
    with Cells(rows) as row:
        code = row.bind(text.sku(row.text("sku")))
        category, uom = row.bind(text.lookup(row.text("category"), CATEGORIES)), row.bind(text.lookup(row.text("uom"), UNITS))
        coded, described, description = row.filled("sku"), row.filled("description"), row.text("description")
    reasons = [F.when(~coded, "MISSING_FIELD").when(code.isNull(), "BAD_CODE"), F.when(~described, "MISSING_FIELD"), F.when(category.isNull() | uom.isNull(), "MISSING_FIELD")]
    return row.finish(reasons, {"sku": code, "description": description, "category": category, "uom": uom})
