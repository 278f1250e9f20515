"""Schemas of stored records and columns of the loan table."""

METRIC_FIELDS = (
    "mode string, threshold double, accuracy double, precision double, recall double, f1 double, "
    "mae double, mse double, rmse double, r2 double, confusion_matrix array<array<bigint>>"
)

# ``seq`` gives the order of appending; ``writer`` settles two appends in the same nanosecond.
RUN_SCHEMA = (
    "timestamp string, task string, model_name string, notes string, "
    f"metrics struct<{METRIC_FIELDS.replace(' string', ':string').replace(' double', ':double').replace(' array', ':array')}>, "
    "seq bigint, writer string"
)
# As stored: ``extra`` has metrics under other names.
STORED_RUN_SCHEMA = f"{RUN_SCHEMA}, extra map<string,double>"

EPOCH_SCHEMA = "run_id string, epoch int, train_loss double, val_loss double, metrics map<string,double>"

# Columns of the loan table by role, in table order.
LOAN_NUMERIC = (
    "loan_amnt",
    "installment",
    "annual_inc",
    "dti",
    "delinq_2yrs",
    "fico_range_low",
    "open_acc",
    "pub_rec",
    "revol_bal",
    "revol_util",
    "total_acc",
    "mort_acc",
    "pub_rec_bankruptcies",
)
LOAN_CATEGORICAL = (
    "term",
    "grade",
    "emp_length",
    "home_ownership",
    "verification_status",
    "purpose",
    "application_type",
)
LOAN_STATUS = "loan_status"
LOAN_RATE = "int_rate"
LOAN_COLUMNS = (*LOAN_NUMERIC, *LOAN_CATEGORICAL, LOAN_STATUS, LOAN_RATE)
LOAN_KEPT_STATUS = ("Fully Paid", "Charged Off")
LOAN_ZERO_STATUS = "Fully Paid"
