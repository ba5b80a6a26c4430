"""Shared inputs of the registered queries: Spark builders and their SQL twins.

The SQL twins are written independently from the Spark code (plain SQL over
the fixture views), so a registered query and its oracle only share the
fixture adapters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import AS_OF, fixture
from ..plans.silver import silver_account, silver_kyc


def account_bronze(fx_account: DataFrame) -> DataFrame:
    """fx_account in the flattened profile-document shape of bronze (all text)."""
    return fx_account.select(
        F.col("AccountNumber").alias("id"), "AccountNumber", "CustomerID",
        F.col("AccountHolderName").alias("Account_AccountHolderName"),
        F.col("AccountType").alias("Account_AccountType"),
        F.col("AccountStatus").alias("Account_AccountStatus"),
        F.col("AccountOpenDate").cast("string").alias("Account_AccountOpenDate"),
        F.col("Balance").cast("string").alias("Account_Balance"),
        F.col("KYC_Done").alias("Account_KYC_Done"),
        F.col("KYC_DocumentVerificationStatus").alias("Account_KYC_DocumentVerificationStatus"),
        F.col("CustomerID").alias("Customer_CustomerID"),
        F.col("AnnualIncome").cast("string").alias("Customer_AnnualIncome"),
        F.col("DOB").cast("string").alias("Customer_DOB"),
        F.col("City").alias("Customer_City"))


def accounts(spark: SparkSession, sf: str) -> DataFrame:
    return silver_account(account_bronze(fixture(spark, sf, "fx_account")), as_of=AS_OF)


def kyc(spark: SparkSession, sf: str) -> DataFrame:
    return silver_kyc(fixture(spark, sf, "fx_kyc"), as_of=AS_OF)


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "fx_transactions")


# ---- SQL twins -----------------------------------------------------------

AS_OF_SQL = f"date '{AS_OF}'"


def age_sql(d: str, as_of: str = AS_OF_SQL) -> str:
    """Whole years by Spark's months_between rule (31-day fraction unless the
    days match or both are month ends)."""
    return (f"cast(floor(((year({as_of}) - year({d})) * 12 + (month({as_of}) - month({d})) + "
            f"case when day({d}) = day({as_of}) or ({d} = last_day({d}) and {as_of} = last_day({as_of})) "
            f"then 0 else (day({as_of}) - day({d})) / 31.0 end) / 12) as bigint)")


ACC_SQL = f"""acc as (
  select distinct AccountNumber as id, AccountNumber, CustomerID,
         AccountHolderName, AccountType, AccountStatus, AccountOpenDate, Balance,
         KYC_Done as Account_KYC_Done,
         KYC_DocumentVerificationStatus as Account_KYC_DocumentVerificationStatus,
         AnnualIncome as Customer_AnnualIncome, DOB as Customer_DOB, City as Customer_City,
         {age_sql('DOB')} as Customer_Age
  from fx_account)"""

KYC_SQL = f"""kyc_s as (
  select distinct CustomerID, DocID, VerificationStatus, IssueDate, ExpiryDate,
         case when ExpiryDate is null then 'UNKNOWN' when ExpiryDate < {AS_OF_SQL} then 'EXPIRED'
              else 'VALID' end as DocumentValidityStatus,
         {age_sql('IssueDate')} as DocumentAgeYears,
         coalesce(lower(VerificationStatus) in ('verified', 'true'), false) as IsVerified
  from fx_kyc)"""
