"""Header titles of the printed reports (fixed values), in column order."""

CUSTOMER_TITLES = ["Customer Name", "City", "State", "Mobile", "Email", "Pincode", "Price", "Weight"]

RULE_LISTING = [
    "Putaway Date", "Ticket Id", "Suborder Code", "RTV Sheet Detail Id", "Barcode", "Issue Category", "Product Name",
    "RPU WayBill No", "Seller Name", "Vendor Code", "Gatepass", "Gatepass Date", "Username", *CUSTOMER_TITLES,
]
LIQUIDATION = [RULE_LISTING[0], "Rule Name", *RULE_LISTING[1:]]

# The second price column is the item price of the returns database; it gets a name of its own.
PUTAWAY_MASTER = [
    "Putaway Date", "Ticket ID", "RPU WayBill No", "Barcode", "Suborder Code", "Issue Category", "Rule Name",
    "Status", "Product Name", "Price", "RTV Date", "Courier Code", "Username", "Warehouse Code",
    *CUSTOMER_TITLES[:-2], "Item Price", "Weight",
]
RTV_DATA = [
    "RTV date", "RTV Sheet Detail Id", "Ticket Id", "Suborder Code", "Customer Name", "Barcode", "Product Name",
    "Issue Category", "Seller Name", "Vendor Code", "Price", "Putaway Date", "RPU WayBill No", "Manifest Date",
    "RTV Courier", "RTV WayBill No", "Username", "Warehouse Code", *CUSTOMER_TITLES[1:-2], "Item Price", "Weight",
]
FULL_BOXES = ["Group Name", "Box Name", "Capacity", "Used", "Warehouse Name"]
TRACKING_NUMBERS = ["Courier Code", "Tracking Numbers"]
PUTAWAY_AND_RTV = ["Date", "Putaway", "RTV Initiated", "RTV Completed", "Pending"]
RPI = [
    "Date", "Total RPI", "Total RPR", "Total QC", "Total Putaway", "Total Returns", "Total Gatepass",
    "Total Liquidation",
]


def to_dispatch_detail(date_title: str) -> list[str]:
    return [
        "Suborder Code", "Issue Category", "Putaway Date", "Dispatch Date", date_title, "Rule Name", "Username",
        "Warehouse Code", "Warehouse",
    ]


TO_DISPATCH_SUMMARY = ["Warehouse", "%1 day", "%2 day", "%3 day", "%5 day", "% >5 day", "Total Dispatch"]
DAILY_SUMMARY = [
    "Date", "Total RPI", "Total Returns Received", "Total QC", "Total Putaway", "45 days hold", "SOI-Non Faulty",
    "Courier Debit", "Total Dispatch",
]
COHORT_SUMMARY = [
    "Date", "Total Returns Received", "Total QC", "%_QC/RPR", "Total Putaway", "45 days hold", "SOI-Non Faulty",
    "Courier Debit", "Total Dispatch", "%_Dispatch",
]
SITE_SUMMARY = [
    "Date", "Total Returns Received", "Total QC", "%_QC/RPR", "Putaway", "45 days hold", "SOI-Non Faulty",
    "Courier Debit", "Total Dispatch", "%_Dispatch", "%_Putaway/QC",
]
SITE_FLOW = ["Date", "Putaway", "45 Days Hold", "Soi-Non Faulty", "Courier Debit", "Total Dispatch"]
RPR_TO_QC = [
    "Qc Warehouse", "Total Qc", "1Day", "(%)1 Day", "2Day", "(%)2 Day", "3Day", "(%)3 Day", "5Day", "(%)5 Day",
    ">5Day", "(%)>5 Day",
]
COURIER_DAYS = ["Courier", "Yest", *[f"Yest - {age} Days" for age in range(1, 7)]]
