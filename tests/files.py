"""Landing files for tests."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

HEADERS = {
    "sales_details": "sls_ord_num,sls_prd_key,sls_cust_id,sls_order_dt,sls_ship_dt,sls_due_dt,"
    "sls_sales,sls_quantity,sls_price",
    "cust_info": "cst_id,cst_key,cst_firstname,cst_lastname,cst_marital_status,cst_gndr,cst_create_date",
    "loc_a101": "CID,CNTRY",
    "prd_info": "prd_id,prd_key,prd_nm,prd_cost,prd_line,prd_start_dt,prd_end_dt",
    "CUST_AZ12": "CID,BDATE,GEN",
    "PX_CAT_G1V2": "ID,CAT,SUBCAT,MAINTENANCE",
}


def text_of(values) -> str:
    return ",".join("" if v is None else str(v) for v in values)


def write_csv(folder, name: str, source: str, rows, stamp: tuple[str, dt.date] | None = None, newline="\n") -> str:
    """One CSV file; ``stamp`` adds a partition column with the same value in every row."""
    header = HEADERS[source] + (f",{stamp[0]}" if stamp else "")
    lines = [text_of([*r, stamp[1]] if stamp else r) for r in rows]
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(newline.join([header, *lines, ""]).encode())
    return str(path)
