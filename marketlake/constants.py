"""Names and numbers that results depend on, kept as plain data."""

# Macro series id -> series name.
MACRO_SERIES = {
    "DFF": "Fed Funds Rate",
    "DGS1MO": "1-Month Treasury Yield",
    "DGS3MO": "3-Month Treasury Yield",
    "DGS6MO": "6-Month Treasury Yield",
    "DGS1": "1-Year Treasury Yield",
    "DGS2": "2-Year Treasury Yield",
    "DGS5": "5-Year Treasury Yield",
    "DGS7": "7-Year Treasury Yield",
    "DGS10": "10-Year Treasury Yield",
    "DGS30": "30-Year Treasury Yield",
    "T10Y2Y": "10Y-2Y Treasury Spread",
    "T10Y3M": "10Y-3M Treasury Spread",
    "T5YIFR": "5-Year Forward Inflation Rate",
    "DFII5": "5-Year Real Treasury Yield",
    "DFII10": "10-Year Real Treasury Yield",
    "CPIAUCSL": "CPI All Items",
    "CPILFESL": "Core CPI ex Food Energy",
    "PCEPI": "PCE Price Index",
    "PCEPILFE": "Core PCE Price Index",
    "PPIACO": "Producer Price Index",
    "MICH": "UMich Inflation Expectations",
    "UMCSENT": "Consumer Sentiment Index",
    "UNRATE": "Unemployment Rate",
    "U6RATE": "U-6 Unemployment Rate",
    "PAYEMS": "Nonfarm Payrolls",
    "CIVPART": "Labor Force Participation",
    "JTSJOL": "Job Openings",
    "JTSHIL": "Hires Level",
    "ICSA": "Initial Jobless Claims",
    "CCSA": "Continuing Jobless Claims",
    "AWHMAN": "Avg Weekly Hours Manufacturing",
    "CES0500000003": "Avg Hourly Earnings",
    "GDP": "Gross Domestic Product",
    "GDPC1": "Real GDP",
    "GDPCA": "Real GDP Growth Rate",
    "INDPRO": "Industrial Production Index",
    "TCU": "Capacity Utilization",
    "IPB50001N": "Business Equipment Production",
    "DGORDER": "Durable Goods Orders",
    "NEWORDER": "Manufacturing New Orders",
    "ISRATIO": "Inventory to Sales Ratio",
    "MNFCTRIRSA": "Manufacturing Inventories",
    "RETAILSMNSA": "Retail Sales",
    "RSXFS": "Retail Sales ex Auto",
    "PCE": "Personal Consumption Expenditures",
    "DSPIC96": "Real Disposable Income",
    "PSAVERT": "Personal Savings Rate",
    "TOTALSL": "Total Consumer Credit",
    "BAMLH0A0HYM2": "High Yield Spread",
    "BAMLC0A0CM": "Investment Grade Spread",
    "DAAA": "Moody AAA Corporate Bond Yield",
    "DBAA": "Moody BAA Corporate Bond Yield",
    "TEDRATE": "TED Spread",
    "DRCCLACBS": "Credit Card Delinquency Rate",
    "BUSLOANS": "Commercial Loans",
    "DPSACBW027SBOG": "Bank Deposits",
    "MORTGAGE30US": "30-Year Mortgage Rate",
    "MORTGAGE15US": "15-Year Mortgage Rate",
    "HOUST": "Housing Starts",
    "HOUST1F": "Single Family Housing Starts",
    "PERMIT": "Building Permits",
    "HSN1F": "New Home Sales",
    "EXHOSLUSM495S": "Existing Home Sales",
    "MSACSR": "Monthly Supply of New Houses",
    "CSUSHPISA": "Case-Shiller Home Price Index",
    "MSPUS": "Median Home Price",
    "EVACANTUSQ176N": "Homeowner Vacancy Rate",
    "RRVRUSQ156N": "Rental Vacancy Rate",
    "M1SL": "M1 Money Supply",
    "M2SL": "M2 Money Supply",
    "BOGMBASE": "Monetary Base",
    "AMBSL": "St Louis Adjusted Monetary Base",
    "WRMFSL": "Money Market Funds",
    "BOPTEXP": "Exports",
    "BOPTIMP": "Imports",
    "XTEXVA01USM667S": "Export Value Index",
    "DEXUSEU": "USD/EUR Exchange Rate",
    "DEXJPUS": "USD/JPY Exchange Rate",
    "DEXUSUK": "USD/GBP Exchange Rate",
    "DEXCHUS": "USD/CNY Exchange Rate",
    "DEXCAUS": "USD/CAD Exchange Rate",
    "DEXBZUS": "USD/BRL Exchange Rate",
    "DEXKOUS": "USD/KRW Exchange Rate",
    "DEXINUS": "USD/INR Exchange Rate",
    "DEXMXUS": "USD/MXN Exchange Rate",
    "DCOILWTICO": "WTI Crude Oil Price",
    "DCOILBRENTEU": "Brent Crude Oil Price",
    "GASREGCOVW": "Regular Gas Price",
    "DHHNGSP": "Natural Gas Price",
    "APU000072610": "Electricity Price",
    "VIXCLS": "CBOE VIX",
    "SP500": "S&P 500 Index",
    "NASDAQCOM": "NASDAQ Composite",
    "DJIA": "Dow Jones Industrial Average",
    "WILL5000PR": "Wilshire 5000",
    "NIKKEI225": "Nikkei 225",
}

# Category -> macro series ids.
MACRO_CATEGORIES = {
    "Interest Rates": [
        "DFF", "DGS1MO", "DGS3MO", "DGS6MO", "DGS1", "DGS2", "DGS5", "DGS7", "DGS10",
        "DGS30",
    ],
    "Yield Curve & Real": [
        "T10Y2Y", "T10Y3M", "T5YIFR", "DFII5", "DFII10",
    ],
    "Inflation": [
        "CPIAUCSL", "CPILFESL", "PCEPI", "PCEPILFE", "PPIACO", "MICH", "UMCSENT",
    ],
    "Labor Market": [
        "UNRATE", "U6RATE", "PAYEMS", "CIVPART", "JTSJOL", "JTSHIL", "ICSA", "CCSA",
        "AWHMAN", "CES0500000003",
    ],
    "GDP & Growth": [
        "GDP", "GDPC1", "GDPCA", "INDPRO", "TCU", "IPB50001N", "DGORDER", "NEWORDER",
        "ISRATIO", "MNFCTRIRSA",
    ],
    "Consumer": [
        "RETAILSMNSA", "RSXFS", "PCE", "DSPIC96", "PSAVERT", "TOTALSL",
    ],
    "Credit & Financial": [
        "BAMLH0A0HYM2", "BAMLC0A0CM", "DAAA", "DBAA", "TEDRATE", "DRCCLACBS", "BUSLOANS",
        "DPSACBW027SBOG",
    ],
    "Housing": [
        "MORTGAGE30US", "MORTGAGE15US", "HOUST", "HOUST1F", "PERMIT", "HSN1F",
        "EXHOSLUSM495S", "MSACSR", "CSUSHPISA", "MSPUS", "EVACANTUSQ176N", "RRVRUSQ156N",
    ],
    "Money Supply": [
        "M1SL", "M2SL", "BOGMBASE", "AMBSL", "WRMFSL",
    ],
    "Trade & FX": [
        "BOPTEXP", "BOPTIMP", "XTEXVA01USM667S", "DEXUSEU", "DEXJPUS", "DEXUSUK", "DEXCHUS",
        "DEXCAUS", "DEXBZUS", "DEXKOUS", "DEXINUS", "DEXMXUS",
    ],
    "Energy & Commodities": [
        "DCOILWTICO", "DCOILBRENTEU", "GASREGCOVW", "DHHNGSP", "APU000072610",
    ],
    "Market Indicators": [
        "VIXCLS", "SP500", "NASDAQCOM", "DJIA", "WILL5000PR", "NIKKEI225",
    ],
}

# Fund symbols, which have no financial statements.
ETF_SYMBOLS = [
    "SPY", "IVV", "VOO", "QQQ", "VTI", "IWM", "IWF", "IWD", "IWB", "ITOT", "SCHB", "VV",
    "MGC", "SPTM", "SCHX", "BND", "AGG", "TLT", "IEF", "SHY", "LQD", "HYG", "JNK", "MUB",
    "VCIT", "VCSH", "BSV", "BIV", "BLV", "GOVT", "VEA", "VWO", "EFA", "EEM", "IEFA", "IEMG",
    "VGK", "VPL", "EWJ", "EWZ", "EWC", "EWG", "EWU", "EWA", "EWH", "XLF", "XLK", "XLV",
    "XLE", "XLI", "XLY", "XLP", "XLU", "XLB", "XLRE", "VNQ", "IYR", "KRE", "XBI", "IBB",
    "GLD", "IAU", "SLV", "USO", "UNG", "DBC", "PDBC", "CORN", "WEAT", "SOYB", "CPER",
    "PALL", "PPLT", "BAR", "SGOL", "MTUM", "USMV", "VLUE", "QUAL", "SIZE", "VIG", "DVY",
    "SDY", "NOBL", "DGRO", "VYM", "HDV", "SCHD", "SPYD", "FVD", "TQQQ", "SQQQ", "UPRO",
    "SPXU", "SSO", "SDS", "TNA", "TZA", "ARKK", "ARKW", "ARKG", "ARKF", "ARKQ", "BOTZ",
    "ROBO", "ICLN", "QCLN", "CNRG", "AIQ", "HACK", "BUG", "CIBR", "WCLD",
]

# RAW valuation field -> column name, ratios first.
VALUATION_RATIOS = {
    "trailingPE": "trailing_pe",
    "forwardPE": "forward_pe",
    "priceToBook": "price_to_book",
    "priceToSalesTrailing12Months": "price_to_sales",
    "enterpriseToEbitda": "ev_to_ebitda",
    "enterpriseToRevenue": "ev_to_revenue",
    "pegRatio": "peg_ratio",
    "grossMargins": "gross_margin",
    "operatingMargins": "operating_margin",
    "profitMargins": "profit_margin",
    "ebitdaMargins": "ebitda_margin",
    "returnOnEquity": "return_on_equity",
    "returnOnAssets": "return_on_assets",
    "debtToEquity": "debt_to_equity",
    "currentRatio": "current_ratio",
    "quickRatio": "quick_ratio",
    "trailingEps": "trailing_eps",
    "forwardEps": "forward_eps",
    "bookValue": "book_value_per_share",
    "revenuePerShare": "revenue_per_share",
    "earningsGrowth": "earnings_growth",
    "revenueGrowth": "revenue_growth",
    "earningsQuarterlyGrowth": "earnings_quarterly_growth",
    "dividendYield": "dividend_yield",
    "payoutRatio": "payout_ratio",
    "trailingAnnualDividendYield": "trailing_annual_dividend_yield",
}
VALUATION_AMOUNTS = {
    "marketCap": "market_cap",
    "enterpriseValue": "enterprise_value",
    "totalRevenue": "total_revenue",
    "ebitda": "ebitda",
    "freeCashflow": "free_cash_flow",
    "operatingCashflow": "operating_cash_flow",
    "totalDebt": "total_debt",
    "totalCash": "total_cash",
}
VALUATION_RISK = {"beta": "beta"}
VALUATION_FIELDS = {**VALUATION_RATIOS, **VALUATION_AMOUNTS, **VALUATION_RISK}

# Statement line item -> pivoted column name.
INCOME_ITEMS = {
    "Total Revenue": "total_revenue",
    "Cost Of Revenue": "cost_of_revenue",
    "Gross Profit": "gross_profit",
    "Operating Income": "operating_income",
    "Net Income": "net_income",
    "EBITDA": "ebitda",
    "EBIT": "ebit",
    "Research And Development": "research_and_development",
    "Selling General And Administration": "selling_general_admin",
    "Interest Expense": "interest_expense",
    "Diluted EPS": "diluted_eps",
    "Basic EPS": "basic_eps",
    "Diluted Average Shares": "diluted_shares",
    "Tax Provision": "tax_provision",
}
BALANCE_ITEMS = {
    "Total Assets": "total_assets",
    "Total Liabilities Net Minority Interest": "total_liabilities",
    "Stockholders Equity": "stockholders_equity",
    "Cash And Cash Equivalents": "cash_and_equivalents",
    "Cash Cash Equivalents And Short Term Investments": "cash_and_short_term_investments",
    "Total Debt": "total_debt",
    "Net Debt": "net_debt",
    "Current Assets": "current_assets",
    "Current Liabilities": "current_liabilities",
    "Inventory": "inventory",
    "Accounts Receivable": "accounts_receivable",
    "Accounts Payable": "accounts_payable",
    "Retained Earnings": "retained_earnings",
    "Net PPE": "net_ppe",
}
CASH_FLOW_ITEMS = {
    "Operating Cash Flow": "operating_cash_flow",
    "Capital Expenditure": "capital_expenditure",
    "Free Cash Flow": "free_cash_flow",
    "Investing Cash Flow": "investing_cash_flow",
    "Financing Cash Flow": "financing_cash_flow",
    "Depreciation And Amortization": "depreciation_and_amortization",
    "Stock Based Compensation": "stock_based_compensation",
    "Common Stock Dividend Paid": "dividends_paid",
    "Repurchase Of Capital Stock": "share_repurchases",
}
LINE_ITEMS = {**INCOME_ITEMS, **BALANCE_ITEMS, **CASH_FLOW_ITEMS}
REQUIRED_ITEMS = ["total_revenue", "total_assets", "operating_cash_flow"]
MARGINS = {
    "gross_margin": "gross_profit",
    "operating_margin": "operating_income",
    "net_margin": "net_income",
}

STATEMENT_TYPES = ["income_statement", "balance_sheet", "cash_flow"]
FREQUENCIES = ["annual", "quarterly"]

# Frame sizes (rows), horizons (calendar days), limits.
TRADING_DAYS = 252
VOLATILITY_ROWS = 30
SENTINEL_LIMIT = 1e18
DEFAULT_LOOKBACK_DAYS = 365
HORIZON_DAYS = [1, 3, 5, 30, 90, 180, 365, 730]
HORIZON_LABELS = ["1D", "3D", "5D", "30D", "90D", "180D", "1Y", "2Y"]
CALENDAR_START = "2009-01-01"
CALENDAR_ROWS = 7000
COVERAGE_EXCLUSIONS = ["FDS"]
UNKNOWN = "Unknown"
OTHER_CATEGORY = "Other"
SYMBOL_PATTERN = r"^[A-Z0-9\-]{1,10}$"
SIZE_BUCKETS = [("Mega", 200e9), ("Large", 10e9), ("Mid", 2e9)]
SMALL_BUCKET = "Small"
NO_SIZE_BUCKET = "ETFs / N/A"
