"""Stand-ins for the four feeds, derived by Spark from the given tables.

The feeds themselves are private.  ``FIXTURES.md`` defines these as pure
functions of ``customer``, ``orders`` and ``events``, with every kind of dirt
the cleaning rules look for; they grow with those tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import CLICK_FEATURES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _month(index: str) -> str:
    """The first of the month ``index`` months after January 2023."""
    return f"add_months(date'2023-01-01', cast({index} as int))"


def _money(cents: str) -> str:
    """Whole cents as text with two decimals, without rounding a double."""
    return f"cast(cast(cast(floor({cents}) as bigint) as decimal(12,0))*0.01 as string)"


def loan_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan ledger: eleven monthly rows per order."""
    return spark.sql(
        f"""
        with schedule as (
          select *, explode(sequence(0, 10)) as n, o_orderkey%13 as paid_until,
                 100+(o_orderkey%90)*10 as instalment
          from {{orders}}
        )
        select 'LN_'||cast(o_orderkey as string) as loan_id,
               'CUS_'||cast(o_custkey as string) as Customer_ID,
               {_month('o_orderkey%14')} as loan_start_date,
               10 as tenure,
               cast(n as int) as installment_num,
               cast(1000+(o_orderkey%90)*100 as float) as loan_amt,
               cast(case when o_orderkey%97=0 then 0 else instalment end as float) as due_amt,
               cast(case when n>paid_until then 0 else instalment end as float) as paid_amt,
               cast(case when o_orderkey%101=0 then null
                         when n>paid_until then (n-paid_until)*instalment-(o_orderkey%3)*5
                         else 0 end as float) as overdue_amt,
               cast((10-n)*instalment as float) as balance,
               {_month('o_orderkey%14+n')} as snapshot_date
        from schedule
        """,
        orders=table(spark, sf_dir, "orders"),
    )


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal attributes: one row per customer, at the month of its cohort."""
    return spark.sql(
        f"""
        select 'CUS_'||cast(c_custkey as string) as Customer_ID,
               c_name as Name,
               case when c_custkey%23=0 then '-500'
                    when c_custkey%29=0 then '2329_'
                    when c_custkey%7=0 then cast(14+c_custkey%60 as string)||'_'
                    else cast(14+c_custkey%60 as string) end as Age,
               cast(100+c_custkey%900 as string)||'-00-0000' as SSN,
               case when c_custkey%14=0 then '_______' else ' '||c_mktsegment||' ' end as Occupation,
               cast({_month('c_custkey%25')} as string) as snapshot_date
        from {{customer}}
        """,
        customer=table(spark, sf_dir, "customer"),
    )


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finances of the same cohort, with every dirty-number and placeholder form."""
    return spark.sql(
        f"""
        with s as (
          select c_custkey as k, cast(round(c_acctbal*100) as bigint) as c from {{customer}}
        )
        select 'CUS_'||cast(k as string) as Customer_ID,
               case when k%61=0 then '2400000.00' when k%59=0 then '344983.50'
                    else {_money('700000+abs(c)*17')}||(case when k%11=0 then '_' else '' end)
                    end as Annual_Income,
               case when k%37=0 then null
                    else {_money('(700000+abs(c)*17)/12.0')} end as Monthly_Inhand_Salary,
               cast(case when k%43=0 then -1 when k%41=0 then 1412 else k%12 end as string)
                    as Num_Bank_Accounts,
               cast(case when k%47=0 then 1381 else k%12 end as string) as Num_Credit_Card,
               cast(case when k%53=0 then 5318 else k%35 end as string) as Interest_Rate,
               case when k%31=0 then '-100' when k%67=0 then '1353' when k%71=0 then '_'
                    when k%17=0 then cast((k+1)%5 as string)
                    else cast(k%5 as string)||(case when k%13=0 then '_' else '' end)
                    end as Num_of_Loan,
               case k%5 when 0 then null when 1 then 'Auto Loan'
                    when 2 then 'Auto Loan, and Payday Loan'
                    when 3 then 'Auto Loan, Not Specified, and Payday Loan'
                    else ' Auto Loan, Student Loan, Not Specified, and Payday Loan '
                    end as Type_of_Loan,
               cast(k%66-5 as string) as Delay_from_due_date,
               case when k%19=0 then cast(k%29 as string)||'_' when k%73=0 then '4182'
                    when k%79=0 then '-3' else cast(k%29 as string) end as Num_of_Delayed_Payment,
               case when k%21=0 then '_' else {_money('c/400.0')} end as Changed_Credit_Limit,
               case when k%83=0 then '1050.0' else cast(k%18 as string)||'.0' end
                    as Num_Credit_Inquiries,
               case when k%9=0 then '_' when k%9=1 then 'Bad' when k%9<5 then 'Standard'
                    else 'Good' end as Credit_Mix,
               {_money('abs(c)/3.0')}||(case when k%15=0 then '_' else '' end) as Outstanding_Debt,
               {_money('2000+k%3000')} as Credit_Utilization_Ratio,
               case when k%25=0 then null when k%33=0 then 'NA'
                    when k%2=0 then cast(k%33 as string)||' Years and '||cast(k%12 as string)||' Months'
                    else cast(k%33 as string)||' Year and '||cast(k%12 as string)||' Month'
                    end as Credit_History_Age,
               case k%7 when 0 then 'NM' when 1 then 'Yes' when 2 then 'Yes' else 'No' end
                    as Payment_of_Min_Amount,
               case when k%26=0 then '82331' when k%27=0 then '-5.50'
                    else {_money('abs(c)/90.0')} end as Total_EMI_per_month,
               case when k%24=0 then '__10000__' else {_money('abs(c)/50.0')} end
                    as Amount_invested_monthly,
               case when k%16=0 then '!@9#%8' else 'Low_spent_Small_value_payments' end
                    as Payment_Behaviour,
               case when k%500=3 then '__-333333333333333333333333333__'
                    else {_money('c/20.0')} end as Monthly_Balance,
               cast({_month('k%25')} as string) as snapshot_date
        from s
        """,
        customer=table(spark, sf_dir, "customer"),
    )


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly behaviour of every user: day d of the events month is month d-1."""

    def feature(i: int) -> str:
        text = f"cast(sum((event_id*{i})%37)-18*count(*) as string)"
        if i == 3:
            text = f"case when user_id%10=0 then 'bad' else {text} end"
        elif i == 5:
            text = f"' '||{text}||' '"
        elif i == 7:
            text = f"case when user_id%9=0 then null else {text} end"
        return f"{text} as fe_{i}"

    features = ",\n".join(feature(i) for i in range(1, len(CLICK_FEATURES) + 1))
    return spark.sql(
        f"""
        select 'CUS_'||cast(user_id as string) as Customer_ID,
               {features},
               cast({_month('extract(day from ts)-1')} as string) as snapshot_date
        from {{events}}
        group by user_id, extract(day from ts)
        """,
        events=table(spark, sf_dir, "events"),
    )


FEEDS = {
    "loan_daily": loan_daily,
    "attributes": attributes,
    "financials": financials,
    "clickstream": clickstream,
}
