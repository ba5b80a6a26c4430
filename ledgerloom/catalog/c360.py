"""Customer 360 family."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import AS_OF, with_fixtures
from ..plans import customer360 as c360
from . import export, register
from .inputs import ACC_SQL, AS_OF_SQL, KYC_SQL, accounts, kyc, transactions

_M12 = f"cast({AS_OF_SQL} - interval 12 month as date)"
_M3 = f"cast({AS_OF_SQL} - interval 3 month as date)"

# Per-account metrics the reference way: join first, then aggregate, with the
# 12-month aggregate computed separately and left-joined.
_METRICS_SQL = f"""{ACC_SQL},
t as (select t.*, a.CustomerID
      from fx_transactions t left join (select distinct AccountNumber, CustomerID from acc) a
      on t.AccountNumber = a.AccountNumber),
m as (select AccountNumber, CustomerID,
             count(*) as Account_Total_Transactions,
             cast(sum(case when Amount < 0 then 1 else 0 end) as bigint) as Account_Total_Debit_Count,
             cast(sum(case when Amount > 0 then 1 else 0 end) as bigint) as Account_Total_Credit_Count,
             sum(case when Amount < 0 then abs(Amount) else 0.0 end) as Account_Total_Spend,
             sum(case when Amount > 0 then Amount else 0.0 end) as Account_Total_Income,
             max(Amount) as Account_Max_Transaction,
             cast(sum(case when Transaction_Status is not null and lower(Transaction_Status) <> 'success'
                           then 1 else 0 end) as bigint) as Account_Failed_Transactions,
             max(Transaction_Date) as Account_Last_Transaction_Date
      from t group by AccountNumber, CustomerID),
m12 as (select AccountNumber,
               sum(case when Amount < 0 then abs(Amount) else 0.0 end) as Account_Spend_12M,
               count(*) as Account_Txn_Count_12M
        from t where Transaction_Date >= {_M12} group by AccountNumber),
metrics as (select m.*, m12.Account_Spend_12M, m12.Account_Txn_Count_12M
            from m left join m12 on m.AccountNumber = m12.AccountNumber)"""

_ROLLUP_SQL = f"""{_METRICS_SQL},
ap as (select a.AccountNumber, a.CustomerID, a.Balance, m.*
       from acc a left join metrics m
       on a.AccountNumber = m.AccountNumber and a.CustomerID = m.CustomerID),
roll as (select a.CustomerID,
                string_agg(distinct a.AccountNumber, ',' order by a.AccountNumber) as Accounts,
                count(distinct a.AccountNumber) as Num_Accounts,
                sum(Balance) as Total_Balance,
                cast(sum(Account_Total_Transactions) as bigint) as Total_Transactions,
                sum(Account_Total_Spend) as Total_Spend,
                sum(Account_Total_Income) as Total_Income,
                cast(sum(Account_Failed_Transactions) as bigint) as Failed_Transactions,
                max(Account_Last_Transaction_Date) as Last_Transaction_Date,
                max(Account_Max_Transaction) as Max_Transaction,
                sum(Account_Spend_12M) as Total_Spend_12M,
                cast(sum(Account_Txn_Count_12M) as bigint) as Txn_Count_12M
         from ap a group by a.CustomerID)"""

_PROFILE_SQL = """prof as (
  select a.CustomerID, cast(null as varchar) as FirstName, cast(null as varchar) as LastName,
         cast(null as varchar) as Email, cast(null as varchar) as Phone, a.Customer_City as City,
         cast(null as varchar) as State, cast(null as varchar) as ZipCode,
         a.Customer_AnnualIncome as AnnualIncome, a.Customer_Age,
         cast(null as varchar) as Occupation, cast(null as varchar) as KYC_Tier,
         cast(null as varchar) as Customer_KYC_Status
  from acc a join (select CustomerID, min(AccountNumber) as mn from acc group by CustomerID) f
    on a.CustomerID = f.CustomerID and a.AccountNumber = f.mn)"""

_KYC_AGG_SQL = f"""{KYC_SQL},
kyc_agg as (select CustomerID, max(VerificationStatus) as Latest_KYC_VerificationStatus,
                   max(ExpiryDate) as Latest_KYC_Expiry, bool_or(IsVerified) as Any_KYC_Verified
            from kyc_s group by CustomerID)"""

_C360_SQL = f"""with {_ROLLUP_SQL},
{_PROFILE_SQL},
{_KYC_AGG_SQL},
j as (select p.*, r.* exclude (CustomerID), k.* exclude (CustomerID)
      from prof p left join roll r on p.CustomerID = r.CustomerID
                  left join kyc_agg k on p.CustomerID = k.CustomerID),
s as (select *,
        coalesce(Latest_KYC_Expiry < {AS_OF_SQL}, false) as Is_KYC_Expired,
        coalesce(Last_Transaction_Date >= {_M3}, false) as Is_Recent_Active,
        least(coalesce(Failed_Transactions, 0) * 2.0, 40.0)
        + least(coalesce(Max_Transaction, 0) / greatest(coalesce(Total_Spend_12M, 1), 1) * 10.0, 40.0)
        + case when Any_KYC_Verified = true then 0.0 else 20.0 end as raw_score
      from j)
select CustomerID, FirstName, LastName, Email, Phone, City, State, ZipCode, Occupation,
       AnnualIncome, Customer_Age, KYC_Tier, Customer_KYC_Status, Latest_KYC_VerificationStatus,
       cast(Latest_KYC_Expiry as varchar) as Latest_KYC_Expiry, Is_KYC_Expired, Any_KYC_Verified,
       Num_Accounts, Total_Balance, Total_Transactions, Total_Spend, Total_Income,
       Total_Spend_12M, Txn_Count_12M, Failed_Transactions,
       cast(Last_Transaction_Date as varchar) as Last_Transaction_Date, Max_Transaction,
       Is_Recent_Active, round(case when raw_score > 100 then 100.0 else raw_score end, 6) as RiskScore
from s"""


@register("customer360", with_fixtures(("fx_transactions", "fx_account", "fx_kyc"), _C360_SQL))
def q_customer360(spark, sf):
    return export(c360.customer360(transactions(spark, sf), accounts(spark, sf), kyc(spark, sf),
                                   as_of=AS_OF))


@register("risk_score", with_fixtures(
    ("fx_transactions", "fx_account", "fx_kyc"),
    _C360_SQL.rsplit("select CustomerID, FirstName", 1)[0]
    + "select CustomerID, round(case when raw_score > 100 then 100.0 else raw_score end, 6) "
      "as RiskScore, Is_KYC_Expired, Is_Recent_Active from s"))
def q_risk_score(spark, sf):
    df = c360.customer360(transactions(spark, sf), accounts(spark, sf), kyc(spark, sf), as_of=AS_OF)
    return export(df.select("CustomerID", "RiskScore", "Is_KYC_Expired", "Is_Recent_Active"))


@register("spend_income_by_customer", with_fixtures(("fx_transactions", "fx_account"), f"""
with {_METRICS_SQL}
select CustomerID, sum(Account_Total_Spend) as Total_Spend, sum(Account_Total_Income) as Total_Income,
       cast(sum(Account_Total_Transactions) as bigint) as Total_Transactions
from metrics where CustomerID is not null group by CustomerID"""))
def q_spend_income(spark, sf):
    return export(c360.spend_income_by_customer(transactions(spark, sf), accounts(spark, sf)))


@register("account_metrics", with_fixtures(("fx_transactions", "fx_account"), f"""
with {_METRICS_SQL}
select AccountNumber, CustomerID, Account_Total_Transactions, Account_Total_Debit_Count,
       Account_Total_Credit_Count, Account_Total_Spend, Account_Total_Income, Account_Max_Transaction,
       Account_Failed_Transactions, cast(Account_Last_Transaction_Date as varchar) as Account_Last_Transaction_Date
from metrics"""))
def q_account_metrics(spark, sf):
    m = c360.account_metrics(transactions(spark, sf), accounts(spark, sf), as_of=AS_OF)
    return export(m.drop("Account_Spend_12M", "Account_Txn_Count_12M"))


@register("account_metrics_12m", with_fixtures(("fx_transactions", "fx_account"), f"""
with {_METRICS_SQL}
select AccountNumber, Account_Spend_12M, Account_Txn_Count_12M from metrics"""))
def q_account_metrics_12m(spark, sf):
    m = c360.account_metrics(transactions(spark, sf), accounts(spark, sf), as_of=AS_OF)
    return export(m.select("AccountNumber", "Account_Spend_12M", "Account_Txn_Count_12M"))


@register("customer_rollup", with_fixtures(("fx_transactions", "fx_account"), f"""
with {_ROLLUP_SQL}
select CustomerID, Num_Accounts, Total_Balance, Total_Transactions, Total_Spend, Total_Income,
       Failed_Transactions, cast(Last_Transaction_Date as varchar) as Last_Transaction_Date,
       Max_Transaction, Total_Spend_12M, Txn_Count_12M from roll"""))
def q_customer_rollup(spark, sf):
    acc = accounts(spark, sf)
    m = c360.account_metrics(transactions(spark, sf), acc, as_of=AS_OF)
    return export(c360.customer_rollup(acc, m))


@register("customer_accounts", with_fixtures(("fx_account",), f"""
with {ACC_SQL}
select distinct CustomerID, AccountNumber from acc where AccountNumber is not null"""))
def q_customer_accounts(spark, sf):
    return c360.customer_accounts(accounts(spark, sf))


@register("customer_profile", with_fixtures(("fx_account",), f"""
with {ACC_SQL}, {_PROFILE_SQL}
select * from prof"""))
def q_customer_profile(spark, sf):
    return export(c360.customer_profile(accounts(spark, sf)))


@register("kyc_aggregate", with_fixtures(("fx_kyc",), f"""
with {_KYC_AGG_SQL}
select CustomerID, Latest_KYC_VerificationStatus, cast(Latest_KYC_Expiry as varchar) as Latest_KYC_Expiry,
       Any_KYC_Verified from kyc_agg"""))
def q_kyc_aggregate(spark, sf):
    return export(c360.kyc_aggregate(kyc(spark, sf)))


@register("silver_account", with_fixtures(("fx_account",), f"""
with {ACC_SQL}
select id, AccountNumber, CustomerID, AccountHolderName, AccountType, AccountStatus,
       cast(AccountOpenDate as varchar) as AccountOpenDate, Balance, Account_KYC_Done,
       Account_KYC_DocumentVerificationStatus, Customer_AnnualIncome,
       cast(Customer_DOB as varchar) as Customer_DOB, Customer_City, Customer_Age from acc"""))
def q_silver_account(spark, sf):
    return export(accounts(spark, sf))


@register("silver_kyc", with_fixtures(("fx_kyc",), f"""
with {KYC_SQL}
select CustomerID, DocID, VerificationStatus, cast(IssueDate as varchar) as IssueDate,
       cast(ExpiryDate as varchar) as ExpiryDate, DocumentValidityStatus, DocumentAgeYears, IsVerified
from kyc_s"""))
def q_silver_kyc(spark, sf):
    return export(kyc(spark, sf))


@register("kyc_validity_counts", with_fixtures(("fx_kyc",), f"""
with {KYC_SQL}
select DocumentValidityStatus, count(*) as n from kyc_s group by DocumentValidityStatus"""))
def q_kyc_validity_counts(spark, sf):
    return kyc(spark, sf).groupBy("DocumentValidityStatus").agg(F.count(F.lit(1)).alias("n"))
