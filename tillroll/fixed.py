"""Values the reports must reproduce exactly.

Fixed values, in the order the two reports use them.  They are business
constants of the original jobs (flags, codes, dates, labels), kept here in
one place so that every operator reads the same literal.
"""

# ---- Fixed values: profit by title ----------------------------------------
CODE_WIDTH = 20  # master item codes are zero-padded to 20 characters
SHORT_CODE_WIDTH = 7  # the short item code is the last 7 characters
TTB_LINE = "TTB"  # product-line flag (UserChar15)
REORDERABLE = "Y"  # reorderable flag
ALIAS_PREFIX = "UPC"  # item alias prefix naming another item's code
POP_RECEIPT_TYPE = 1  # legacy purchasing receipt type counted
POP_CUTOFF = "2010-06-30"  # legacy receipts count before this date
RETURN_FLAG = "Y"  # register line is a return ('y' before normalisation)
NOT_RETURN_FLAG = "N"  # register line is a sale ('n' before normalisation)
SALE_TYPE = "S"  # register transaction type counted
RETAIL_FLAG = "Y"  # location is a retail store
ACTIVE_STATUS = "A"  # location status counted
STORE_NO_RANGE = (1, 200)  # store numbers counted as retail
SOP_INVOICE_TYPE = 3  # wholesale document type counted
INTERNAL_CUSTOMERS = ("SAMPLE", "REPS")  # wholesale customers that are not sales
SOP_DOC_ID = "STD"  # wholesale document id counted
SOP_VOID_BATCH = "Sales Void"  # wholesale batch source left out
INTERNAL_CUSTOMER_PREFIXES = ("MRDC", "RDC", "TTB")  # customer-code prefixes left out
NO_DATE_TEXT = "NA"  # received date shown when there is none
SENTINEL_DATE = (1900, 1, 1)  # the date an empty string converts to
PERCENT_SUFFIX = " %"

# ---- Fixed values: shipments not received ---------------------------------
FILTER_TYPES = ("All Locations", "Store", "District", "Region", "RDC", "State")
PARAM_CHAR_WIDTH = 20  # FilterType and DynFilter are char(20)
VENDOR_PARAM_WIDTH = 10  # VendorID is varchar(10)
STORE_TYPE = "S"  # LocationType of a store
RDC_EXCLUDED = ("00451", "00710", "00999")  # stores the RDC filter leaves out
LOCATION_NO_WIDTH = 5  # #LOCS LocationNo char(5)
LOCATION_NAME_WIDTH = 30  # #LOCS LocationName char(30)
ALL_VENDORS = "All"  # VendorID choosing every shipment type
WAREHOUSE_VENDOR = "CDC"  # VendorID choosing warehouse shipments; their label
MODE_TYPES = {"all": ("W", "R"), "cdc": ("W",), "vendor": ("R",)}  # shipment types per mode
WAREHOUSE_TYPE = "W"  # warehouse shipment type
DROP_SHIP_TYPE = "R"  # drop-shipment type
SUPPLY_COMPANY = "SUP"  # supply lines, never received
NO_VENDOR_TEXT = "No Shipping Detail"  # vendor label when there is no vendor
LABEL_SEPARATOR = " - "
US_DATE_FORMAT = "MM/dd/yyyy"  # convert(varchar(10), d, 101)
