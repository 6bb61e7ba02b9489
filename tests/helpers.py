from hourmeter.model import event_types_df
from hourmeter.operators.cleaning import clean_records
from hourmeter.sources import files as FS

PREFIX = "acme"
MACHINES_CSV = "RefNo.,BranchName,MachineType\nQX70,Millpond,Forklift\nT4 ,Quayside,PPT\n"
HDR = "DateAndTime,RefNo.,BranchName,TxFlagStrings,RunHours,DriverName,DriverSurname"
FILE = "2026-09-08_DailyTelemetryData.csv"


def machines(spark, write_files):
    d = write_files({"machine_list.csv": MACHINES_CSV}, sub="ml")
    return FS.read_machine_list(spark, d + "/machine_list.csv")


def clean_texts(spark, write_files, files: dict):
    d = write_files(files)
    recs = FS.read_daily_csv(spark, [d + "/" + n for n in files])
    listing = spark.createDataFrame([(n,) for n in files], "file_name string")
    return clean_records(
        recs, machines(spark, write_files).checkpoint(), event_types_df(spark), files=listing, branch_prefix=PREFIX, cut=lambda df: df.checkpoint()
    )
